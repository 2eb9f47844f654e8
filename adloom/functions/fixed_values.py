"""Word lists, lookup tables and patterns that outputs must reproduce exactly.

Nothing here is logic. Vocabularies of brands, models and the long global model-alias list are not
kept here at all; they are read from files (see ``adloom.sources.vocabulary``).
"""

# --- blanks and placeholders -------------------------------------------------------------------
DASHES = ["-", "—", "–"]
PLACEHOLDERS = DASHES + ["null", "None"]
PLACEHOLDERS_FOLDED = DASHES + ["null", "none"]
UNSPECIFIED = ["غير محدد", "غير_محدد", "-"]
OTHER_SPELLINGS = ["أخرى", "أخري", "اخرى", "اخري"]
OTHER_CANONICAL = "غير ذلك"
OTHER_FIELDS = [
    "condition", "exterior_color", "fuel_type", "engine_size", "transmission",
    "body_type", "drive_system", "city", "listing_type", "model",
]
BAD_MAKES = OTHER_SPELLINGS + ["غير محدد", "غير_محدد", "other", "Other", "-"]
NO_LOCATION = ["غير معروف", "غير_معروف", "Unknown", "-"]
NO_PHONE = ["None", "null", "0"]

# --- gates -------------------------------------------------------------------------------------
MANDATORY_FIELDS = ["make", "model", "year", "fuel_type", "city", "price", "phone", "seller_name"]
MANDATORY_SKIP = [
    "", "-", "—", "–", "null", "none", "0",
    "غير معروف", "غير_معروف", "غير محدد", "غير_محدد", "n/a",
]
QUALITY_FIELDS = [
    "make", "model", "year", "body_type", "exterior_color", "interior_color", "fuel_type",
    "engine_size", "transmission", "condition", "city", "mileage", "price", "phone", "seller_name",
]
QUALITY_BAD = ["غير معروف", "n/a", "N/A", "-", "none", "None"]
MIN_YEAR = 2015
MIN_ENGINE_CC = 100
MAX_HEIGHT_TO_WIDTH = 0.95
MIN_BRIGHTNESS = 55

# --- Arabic folding and Latin transliteration ----------------------------------------------------
FOLD_FROM = "إأآٱةىـ"
FOLD_TO = "ااااهي"
ARABIC_RUN = "[؀-ۿ]+"
DIGITS_FROM = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹"
DIGITS_TO = "01234567890123456789"
DIGRAPHS = {
    "ch": "تش", "sh": "ش", "th": "ث", "ph": "ف", "gh": "غ",
    "kh": "خ", "ck": "ك", "qu": "كو", "oo": "و", "ee": "ي",
}
LETTERS = {
    "a": "ا", "b": "ب", "c": "ك", "d": "د", "e": "", "f": "ف", "g": "ج", "h": "ه", "i": "ي",
    "j": "ج", "k": "ك", "l": "ل", "m": "م", "n": "ن", "o": "و", "p": "ب", "q": "ك", "r": "ر",
    "s": "س", "t": "ت", "u": "و", "v": "ف", "w": "و", "x": "كس", "y": "ي", "z": "ز",
}

# --- canonical aliases per field (keys compared folded and lower-cased) ---------------------------
FIELD_ALIASES = {
    "doors": {
        "2": "بابين", "بابين": "بابين", "3": "3 أبواب", "4": "4 أبواب", "5": "5 أبواب",
    },
    "fuel_type": {
        "ديزل": "ديزل / مازوت", "مازوت": "ديزل / مازوت", "diesel": "ديزل / مازوت",
        "petrol": "بنزين", "gasoline": "بنزين", "electric": "كهربائي", "hybrid": "هجين",
        "كهرباء": "كهربائي",
    },
    "drive_system": {
        "4x4": "دفع رباعي", "4×4": "دفع رباعي", "awd": "دفع رباعي", "4wd": "دفع رباعي",
        "fwd": "دفع أمامي", "rwd": "دفع خلفي", "دفع امامي": "دفع أمامي",
        "دفع خلفي": "دفع خلفي", "دفع رباعي": "دفع رباعي",
    },
    "transmission": {
        "automatic": "أوتوماتيك", "auto": "أوتوماتيك", "اوتوماتيك": "أوتوماتيك",
        "manual": "يدوي", "يدوي": "يدوي", "semi-automatic": "شبه أوتوماتيك",
        "شبه اوتوماتيك": "شبه أوتوماتيك",
    },
    "origin": {
        "korean": "كوري", "american": "أمريكي", "european": "اوروبي", "gulf": "خليجي",
        "canadian": "كندي", "syrian": "نمرة سورية", "امريكي": "أمريكي", "سوري": "نمرة سورية",
        "سورية": "نمرة سورية", "نمرة سوري": "نمرة سورية", "نمره سورية": "نمرة سورية",
        "نمره سوريه": "نمرة سورية", "صينية": "صيني", "يابانية": "ياباني",
    },
    "body_type": {
        "sedan": "سيدان", "suv": "SUV", "إس يو في": "SUV", "اس يو في": "SUV", "van": "ڤان",
        "فان": "ڤان", "coupe": "كوبيه", "hatchback": "هاتشباك", "truck": "نقل", "pickup": "نقل",
        "بيك اب": "نقل", "بيك أب": "نقل", "شاحنة خفيفة": "نقل", "مركبة ثقيلة": "نقل",
        "باص": "نقل", "شاحنة بيك أب": "نقل", "شاحنة بيكآب": "نقل", "كروس أوفر": "كروس",
        "ستيشن واجن": "واجن", "كشف": "كوبيه", "مايكرو فان": "ميني فان", "فاتسباك": "هاتشبك",
        "فاستباك": "هاتشبك",
    },
    "city": {
        "النبك": "ريف دمشق", "محردة": "ريف دمشق", "دوما": "ريف دمشق", "السلمية": "حماه",
        "أعزاز": "حلب", "الطبقة": "الرقة", "صافيتا": "طرطوس",
    },
    "make": {
        "مرسيدس": "مرسيدس", "مرسيدس بنز": "مرسيدس", "mercedes": "مرسيدس",
        "mercedes-benz": "مرسيدس", "سامسونغ": "رينو سامسونج", "bmw": "بي ام دبليو",
        "بي ام دابليو": "بي ام دبليو", "vw": "فولكس فاجن", "volkswagen": "فولكس فاجن",
        "فولكسفاغن": "فولكس فاجن", "hyundai": "هيونداي", "kia": "كيا", "toyota": "تويوتا",
        "nissan": "نيسان", "honda": "هوندا", "chevrolet": "شيفروليه", "chevy": "شيفروليه",
        "ford": "فورد", "lexus": "لكزس", "audi": "أودي", "ميتسوبيشي": "ميتسوبيشي",
        "mitsubishi": "ميتسوبيشي", "subaru": "سوبارو", "suzuki": "سوزوكي", "mazda": "مازدا",
        "land rover": "لاند روفر", "landrover": "لاند روفر", "cadillac": "كاديلاك",
        "porsche": "بورش", "maserati": "مازيراتي", "peugeot": "بيجو", "renault": "رينو",
        "daewoo": "دايو", "chery": "شيري", "haval": "هافال", "mg": "ام جي",
        "infiniti": "إنفينيتي", "انفينيتي": "إنفينيتي", "إنفينيتي": "إنفينيتي", "جيب": "جيب",
        "jeep": "جيب", "dodge": "دودج", "chrysler": "كرايسلر", "volvo": "فولفو",
        "skoda": "سكودا", "seat": "سيات", "fiat": "فيات", "opel": "أوبل", "citroen": "سيتروين",
        "geely": "جيلي", "byd": "بي واي دي", "changan": "شانجان", "proton": "بروتون",
        "dacia": "داسيا",
    },
}

# Model aliases that hold for one make only (keys compared folded and lower-cased).
MAKE_MODEL_ALIASES = {
    "أودي": {
        "a5 coupe": "A5", "a6 3.0 tfsi": "A6", "a3 sedan": "A3", "a5 2.0t": "A5",
        "s8": "نماذج RS", "a7 3.0t": "A7", "q7 3.0 tfsi": "Q7", "a8 3.0 tdi": "A8",
        "a4 2.0t": "A4",
    },
    "بروتون": {"بروتون ساجا": "ساجا", "proton gen-2": "جين 2"},
    "بي ام دبليو": {
        "130i": "الفئة 1", "316": "الفئة 3", "320d": "الفئة 3", "420d": "الفئة 4",
        "520d": "الفئة 5", "530d": "الفئة 5", "550i": "الفئة 5", "m3": "M", "m3 e36": "M",
        "m5": "M", "m5 e34": "M", "series 7": "الفئة 7", "x3 m": "XM", "x6 m": "XM",
    },
    "تسلا": {"تسلا مودل ي": "الموديل Y"},
    "الفا روميو": {"جيوليتتا": "جولييتا"},
    "تويوتا": {"افانزا": "أفانزا", "الفارد": "ألفارد", "هياك": "هايس"},
    "جاكوار": {"jaguar 5": "جاكوار 5"},
    "جيلي": {"geely ck1": "CK1", "geely ck2": "CK2"},
    "داسيا": {"لوجان": "لوغان"},
    "دودج": {"ram": "رام"},
    "سكودا": {"سوبرب": "سوبيرب", "وكتافيا": "اوكتافيا", "وكتافيا لجانك": "اوكتافيا"},
    "سوبارو": {"يمبرزا": "امبريزا"},
    "سوزوكي": {"التو": "ألتو"},
    "سيات": {"لون": "ليون"},
    "سيتروين": {"برلينجو": "بيرلينجو"},
    "شيري": {"tiggo 3": "تيغو"},
    "شيفروليه": {
        "silverado 1500": "سيلفارادو", "silverado z71": "سيلفارادو", "tahoe z71": "تاهو",
        "تاهو برمير": "تاهو", "ماليبو لت": "ماليبو",
    },
    "فولفو": {"volvo v40": "V40"},
    "فيات": {"سينا": "سينيا"},
    "كيا": {"سبورتاج جت-لين": "سبورتاج", "سدونا": "سيدونا"},
    "مرسيدس": {
        "190": "الفئة C", "200": "الفئة C", "240": "الفئة C", "300": "الفئة E",
        "320": "الفئة E", "350": "الفئة S", "400": "الفئة S", "420": "الفئة S",
        "450": "الفئة S", "500": "الفئة S", "600": "الفئة S", "s-class": "الفئة S",
        "م-كلاسس": "الفئة M", "amg a 45": "AMG", "amg c 43": "AMG", "amg c 63": "AMG",
        "amg e 43": "AMG", "amg gle 53": "AMG", "amg s 63": "AMG", "amg sl 55": "AMG",
    },
    "ميني": {"كوبر": "كومنتري مان", "كوبر س": "كومنتري مان", "كوونتريمان": "كومنتري مان"},
    "نيسان": {"كس-ترايل": "اكس ترايل"},
    "هوندا": {"h-1 grand starex": "ستاركس"},
    "هيونداي": {
        "سانتافي": "سانتا في", "جنسيس كووب": "جينسس", "فلوستر ن": "فوليستر",
        "كسكل": "إكسل", "لافستا": "لافيستا", "لانترا هيبريد": "هيونداي إلنترا",
        "يونيك": "أيونيك",
    },
}
MAKE_LIST_KEY = {"مرسيدس": "مرسيدس بنز"}
MAKE_OVERRIDES = {"مرسيدس بنز": "مرسيدس"}
JUNK_BRANDS = ["ماركة", "Not set"]
LEXUS_NAMES = ["لكزس", "lexus"]
BRAND_PREFIXES = [
    "toyota", "hyundai", "kia", "nissan", "honda", "chevrolet", "ford", "volkswagen", "vw",
    "bmw", "mercedes-benz", "mercedes", "lexus", "audi", "porsche", "peugeot", "mazda",
    "mitsubishi", "subaru", "suzuki", "land rover", "saipa", "daewoo", "chery", "infiniti",
    "مرسيدس", "تويوتا", "هيونداي", "كيا", "نيسان",
]
MATCH_THRESHOLD = 0.75

# --- title and keyword detection -----------------------------------------------------------------
KNOWN_BRANDS = [
    "Toyota", "Kia", "Hyundai", "Nissan", "Honda", "Mitsubishi", "Mercedes", "BMW", "Audi",
    "Volkswagen", "Ford", "Chevrolet", "GMC", "Dodge", "Jeep", "Land Rover", "Lexus", "Mazda",
    "Subaru", "Suzuki", "Peugeot", "Renault", "Skoda", "SEAT", "Opel", "Volvo", "Fiat", "Alfa",
    "Citroen", "Infiniti", "Acura", "Lincoln", "Cadillac", "Buick", "Chrysler", "Tesla", "BYD",
    "Geely", "Chery", "Haval", "MG", "Isuzu", "Datsun", "Porsche", "Range",
]
BRAND_NAMES_AR = {
    "تويوتا": "Toyota", "كيا": "Kia", "هيونداي": "Hyundai", "هونداي": "Hyundai",
    "نيسان": "Nissan", "هوندا": "Honda", "ميتسوبيشي": "Mitsubishi", "مرسيدس": "Mercedes",
    "بي ام دبليو": "BMW", "اودي": "Audi", "فولكس": "Volkswagen", "فورد": "Ford",
    "شيفروليه": "Chevrolet", "جي ام سي": "GMC", "دودج": "Dodge", "جيب": "Jeep",
    "لاند روفر": "Land Rover", "لكزس": "Lexus", "مازدا": "Mazda", "سوزوكي": "Suzuki",
    "بيجو": "Peugeot", "رينو": "Renault", "اوبل": "Opel", "فولفو": "Volvo", "فيات": "Fiat",
    "انفينيتي": "Infiniti", "شيري": "Chery", "جيلي": "Geely", "هافال": "Haval",
}
TITLE_STOP_WORDS = ["used", "new", "for", "sale", "rent", "the", "and", "with"]
FUEL_KEYWORDS = {
    "بنزين": "بنزين", "gasoline": "بنزين", "petrol": "بنزين", "ديزل": "ديزل", "diesel": "ديزل",
    "غاز": "غاز", "lpg": "غاز", "كهرباء": "كهرباء", "كهربائي": "كهرباء", "electric": "كهرباء",
    "هجين": "هجين", "hybrid": "هجين",
}
TRANSMISSION_KEYWORDS = {
    "أوتوماتيك": "أوتوماتيك", "اوتوماتيك": "أوتوماتيك", "automatic": "أوتوماتيك",
    "auto": "أوتوماتيك", "يدوي": "يدوي", "manual": "يدوي", "عادي": "يدوي",
}
CONDITION_KEYWORDS = {
    "جديدة": "جديدة", "جديد": "جديدة", "new": "جديدة", "مستعملة": "مستعملة",
    "مستعمل": "مستعملة", "مستخدمة": "مستعملة", "used": "مستعملة",
}
LISTING_TYPES = {
    "sell": "بيع", "rent": "إيجار", "بيع": "بيع", "إيجار": "إيجار",
    "للبيع": "بيع", "للإيجار": "إيجار",
}
SALE, RENT = "بيع", "إيجار"
FOR_SALE, FOR_RENT = "للبيع", "للإيجار"
BRAND_NEW = "جديدة"
RENT_WORDS = ["للإيجار", "للايجار", "للتأجير", "إيجار"]
RENT_WORDS_SHORT = ["إيجار", "ايجار", "للإيجار"]
USED_WORDS, NEW_WORDS = ["مستعمل", "مستعملة"], ["جديد", "جديدة"]
USED, NEW = "مستعمل", "جديد"
TITLE_PREFIXES = [
    "للبيع سيارة", "للإيجار سيارة", "سيارة للبيع", "سيارة للإيجار", "للبيع", "للإيجار", "سيارة",
]
TITLE_TRAIL = ["زيرو", "جديد", "جديدة", "مستعمل", "مستعملة", "مشابه"]
MULTI_WORD_MAKES = [
    "بي ام دبليو", "جي ام سي", "رانج روفر", "لاند روفر", "رولز رويس", "أستون مارتن",
    "ألفا روميو", "مان تراك",
]
IN_PLACE = " في "
ALL_MODELS = "كل الفئات"
KM_UNIT = "كم"
THOUSAND = "ألف"

# --- dates ---------------------------------------------------------------------------------------
MONTH_NAMES = {
    "يناير": 1, "فبراير": 2, "مارس": 3, "أبريل": 4, "مايو": 5, "يونيو": 6, "يوليو": 7,
    "أغسطس": 8, "سبتمبر": 9, "أكتوبر": 10, "نوفمبر": 11, "ديسمبر": 12, "January": 1,
    "February": 2, "March": 3, "April": 4, "May": 5, "June": 6, "July": 7, "August": 8,
    "September": 9, "October": 10, "November": 11, "December": 12,
}
NOW_WORDS = ["now", "الآن", "الان"]
UNIT_DAYS_EN = {
    "second": 0, "minute": 0, "hour": 0, "day": 1, "week": 7, "month": 30, "year": 365,
}
UNIT_DAYS_AR = {
    "ثانية": 0, "دقيقة": 0, "ساعة": 0, "يوم": 1, "أيام": 1, "أسبوع": 7, "أسابيع": 7,
    "شهر": 30, "أشهر": 30, "سنة": 365, "سنوات": 365,
}

# --- media and contact ---------------------------------------------------------------------------
IMAGE_NOISE = ["icon", "logo", "placeholder", "avatar", "flag", "sprite", "banner"]
MIN_IMAGE_URL = 30
CONTACT_WRAPPERS = ["car", "data", "result", "listing", "item", "ad"]
PHONE_KEYS = [
    "phone", "mobile", "telephone", "phoneNumber", "phone_number", "contact_number",
    "contactNumber", "tel",
]
WHATSAPP_KEYS = ["whatsapp", "wa", "wa_number", "whatsapp_number", "whatsappNumber"]

# --- envelopes -----------------------------------------------------------------------------------
ENVELOPE_KEYS = ["data", "results", "ads", "items", "records", "listings"]
ENVELOPE_KEYS_PRODUCTION = ["data", "ads", "results", "items", "records", "listings"]
ENVELOPE_KEYS_NON_EMPTY = ["data", "classifieds", "results", "items"]
TOTAL_KEYS = ["total", "count", "totalCount", "total_count"]
META_TOTAL_KEYS = ["total", "count", "totalItems"]
LISTING_MARKER = "search/ads"

# --- value translations per source profile ---------------------------------------------------------
COLORS_EN = {
    "white": "أبيض", "black": "أسود", "silver": "فضي", "grey": "رمادي", "gray": "رمادي",
    "red": "أحمر", "blue": "أزرق", "green": "أخضر", "yellow": "أصفر", "orange": "برتقالي",
    "brown": "بني", "beige": "بيج", "gold": "ذهبي", "champagne": "شمبانيا", "pearl": "لؤلؤي",
    "maroon": "كستنائي", "purple": "بنفسجي", "other": "آخر",
}
BODIES_EN = {
    "sedan": "سيدان", "suv": "دفع رباعي", "pickup": "بيكاب", "hatchback": "هاتشباك",
    "coupe": "كوبيه", "wagon": "ستيشن واغن", "van": "فان", "minivan": "ميني فان",
    "convertible": "كشف", "truck": "شاحنة", "bus": "باص",
}
CONDITIONS_EN = {"used": "مستعمل", "new": "جديد", "damaged": "متضرر"}
CLASSIFIED_TRANSMISSIONS = {
    "automatic": "أوتوماتيك", "manual": "مانيوال", "normal": "مانيوال", "cvt": "CVT",
}
CLASSIFIED_FUELS = {
    "gasoline": "بنزين", "petrol": "بنزين", "oil": "بنزين", "diesel": "ديزل",
    "electric": "كهربائي", "hybrid": "هايبرد", "gas": "غاز",
}
CLASSIFIED_DRIVES = {
    "fwd": "دفع أمامي", "rwd": "دفع خلفي", "4wd": "دفع رباعي", "awd": "دفع رباعي كامل",
    "4x4": "دفع رباعي", "front": "دفع أمامي", "rear": "دفع خلفي",
}
CLASSIFIED_ORIGINS = {
    "local": "محلي", "imported": "مستورد", "gcc": "خليجي", "european": "أوروبي",
    "american": "أمريكي", "japanese": "ياباني", "korean": "كوري", "syria_agency": "وكالة سورية",
}
CLASSIFIED_SPECIFICATIONS = {
    "full": "كاملة المواصفات", "gcc": "مواصفات خليجية", "american": "مواصفات أمريكية",
    "european": "مواصفات أوروبية", "japanese": "مواصفات يابانية", "standard": "قياسي",
    "third_class": "الفئة الثالثة فأدنى",
}
CLASSIFIED_CITIES = {
    "damascus": "دمشق", "aleppo": "حلب", "homs": "حمص", "latakia": "اللاذقية",
    "tartous": "طرطوس", "tartus": "طرطوس", "hama": "حماة", "daraa": "درعا",
    "deir_ez_zor": "دير الزور", "idlib": "إدلب", "raqqa": "الرقة", "hasakah": "الحسكة",
    "qamishli": "القامشلي", "suwayda": "السويداء", "quneitra": "القنيطرة",
}
WIDE_FUELS = {
    "oil": "بنزين", "diesel": "ديزل", "gas": "غاز", "electric": "كهربائي", "hybrid": "هجين",
}
WIDE_TRANSMISSIONS = {
    "automatic": "أوتوماتيك", "manual": "يدوي", "semi_auto": "نصف أوتوماتيك",
}
WIDE_DRIVES = {
    "front": "دفع أمامي", "rear": "دفع خلفي", "4x4": "دفع رباعي", "four": "دفع رباعي",
    "all": "دفع كلي",
}
WIDE_ORIGINS = {
    "eroupean_american_import": "استيراد أوروبي/أمريكي",
    "european_american_import": "استيراد أوروبي/أمريكي", "local": "محلي",
    "gulf_import": "استيراد خليجي", "khaleg_import": "استيراد خليجي",
    "chinese_import": "استيراد صيني", "korean_import": "استيراد كوري",
    "japanese_import": "استيراد ياباني",
}
WIDE_SPECIFICATIONS = {
    "first_class": "الفئة الأولى", "second_class": "الفئة الثانية",
    "third_class": "الفئة الثالثة", "full_option": "فل أوبشن", "half_option": "نصف أوبشن",
}
WIDE_CITIES = {
    "damascus": "دمشق", "aleppo": "حلب", "homs": "حمص", "latakia": "اللاذقية", "hama": "حماة",
    "tartus": "طرطوس", "deir_ez_zor": "دير الزور", "idlib": "إدلب", "raqqa": "الرقة",
    "daraa": "درعا", "quneitra": "القنيطرة", "suwayda": "السويداء", "hasaka": "الحسكة",
    "rif_dimashq": "ريف دمشق",
}
ORIGIN_LABEL, SPECIFICATION_LABEL = "المصدر: ", "المواصفات: "
ADVERT_TRANSMISSIONS = {
    "automatic": "أوتوماتيك", "manual": "مانيوال", "cvt": "CVT", "dct": "DCT",
}
ADVERT_FUELS = {
    "gasoline": "بنزين", "diesel": "ديزل", "electric": "كهربائي", "hybrid": "هايبرد",
    "gas": "غاز",
}
ADVERT_DRIVES = {
    "fwd": "دفع أمامي", "rwd": "دفع خلفي", "4wd": "دفع رباعي", "awd": "دفع رباعي كامل",
    "4x4": "دفع رباعي",
}

# --- label -> field dictionaries (a leading underscore marks a label that is dropped) --------------
REVERSED_LABELS = {
    "الموديل": "brand", "الماركة": "model", "السنة": "year", "الكيلومترات": "mileage",
    "نوع الوقود": "fuel_type", "المحرك": "engine", "ناقل الحركة": "transmission",
    "اللون الخارجي": "color", "اللون الداخلي": "interior_color", "الأسطوانات": "cylinders",
    "المقاعد": "_seats", "المفاتيح": "_keys", "نظام الدفع": "drive_system",
    "المصدر": "_origin", "المواصفات": "specs_category", "الحالة": "condition",
    "نوع الهيكل": "body_type", "عدد الأبواب": "doors", "الأبواب": "doors",
    "رقم الشاصي": "vin", "VIN": "vin",
}
GENERIC_LABELS = {
    "الماركة": "brand", "ماركة السيارة": "brand", "الصانع": "brand", "الموديل": "model",
    "موديل السيارة": "model", "السنة": "year", "سنة الصنع": "year", "الكيلومترات": "mileage",
    "المسافة المقطوعة": "mileage", "عداد المسافة": "mileage", "نوع الوقود": "fuel_type",
    "الوقود": "fuel_type", "المحرك": "engine", "حجم المحرك": "engine", "سعة المحرك": "engine",
    "ناقل الحركة": "transmission", "ناقل": "transmission", "نوع الناقل": "transmission",
    "اللون": "color", "اللون الخارجي": "color", "لون السيارة": "color",
    "اللون الداخلي": "interior_color", "لون الفرش": "interior_color",
    "الأسطوانات": "cylinders", "عدد الأسطوانات": "cylinders", "الأبواب": "doors",
    "عدد الأبواب": "doors", "رقم الشاصي": "vin", "رقم VIN": "vin", "VIN": "vin",
    "الشاصي": "vin", "الحالة": "condition", "نوع الهيكل": "body_type",
    "هيكل السيارة": "body_type", "نوع الجسم": "body_type", "الموقع": "location",
    "المدينة": "location", "المحافظة": "location", "المنطقة": "location",
    "المصدر": "_origin", "الوارد الإقليمي": "_origin", "المقاعد": "_seats",
    "عدد المقاعد": "_seats", "جهة القيادة": "_steering", "قوة الحصان": "_horsepower",
    "الضمان": "_warranty", "حالة الهيكل": "_body_cond", "نظام الدفع": "drive_system",
    "نوع الدفع": "drive_system", "جسم المركبة": "body_type", "موديل المركبة": "model",
    "حالة المركبة": "condition", "رقم الهيكل": "vin",
}
PORTAL_LABELS = {
    "السنة": "year", "المدينة": "city", "الماركة": "make", "الموديل": "model",
    "الحالة": "condition", "الكيلومتراج": "mileage", "نوع الجسم": "body_type",
    "الوقود": "fuel_type", "نوع الوقود": "fuel_type", "المحرك": "engine_size",
    "الغيار": "transmission", "ناقل الحركة": "transmission", "الناقل": "transmission",
    "الانتقال": "transmission", "اللون الخارجي": "exterior_color",
    "اللون الداخلي": "interior_color", "نظام الدفع": "drive_system",
    "نوع الدفع": "drive_system", "عدد الأبواب": "doors", "عدد الابواب": "doors",
    "الأبواب": "doors", "السلندرات": "cylinders", "عدد السلندرات": "cylinders",
    "رقم الهيكل": "chassis_number", "رقم الشاصي": "chassis_number", "History": "_history",
    "الوارد": "_origin", "الاستيراد": "_origin", "الموديل الفرعي": "_submodel",
}
GRID_LABELS = {
    "السعر": "price", "الماركة": "make", "الموديل": "model", "المسافة المقطوعة": "mileage",
    "الهيكل": "body_type", "سنة التصنيع": "year", "المحروقات": "fuel_type",
    "ناقل السرعة": "transmission", "الحالة": "condition", "قوة المحرك": "engine_power",
    "حجم المحرك": "engine_size", "الدفع": "drive_system", "اللون": "exterior_color",
    "الكفالة": "warranty", "المعلن": "seller_type", "رقم الإعلان": "listing_id",
    "تاريخ الإعلان": "date_added",
}
ACCORDION_LABELS = {
    "نوع المركبة": "make", "جسم المركبة": "body_type", "اللون الخارجي": "exterior_color",
    "نوع الوقود": "fuel_type", "سعة المحرك": "engine_size", "عدد الأسطوانات": "cylinders",
    "عدد الأبواب": "doors", "جهة القيادة": "steering_side", "حالة الهيكل": "chassis_condition",
    "موديل المركبة": "model", "ناقل الحركة": "transmission", "اللون الداخلي": "interior_color",
    "قوة الحصان": "horsepower", "الوارد الإقليمي": "origin", "عدد المقاعد": "seats",
    "حالة المركبة": "condition", "الضمان": "warranty", "رقم الهيكل": "chassis_number",
}
ADVERT_SLUGS = {
    "traveled_distance": "mileage", "year_of_manufacture": "year", "color": "exterior_color",
    "Color": "exterior_color", "exterior_color": "exterior_color",
    "interior_color": "interior_color", "fuel_type": "fuel_type", "Fuel_type": "fuel_type",
    "transmission": "transmission", "Transmission": "transmission", "gearbox": "transmission",
    "condition": "condition", "Condition": "condition", "car_condition": "condition",
    "engine_capacity": "engine_size", "engine": "engine_size", "body_type": "body_type",
    "drive_system": "drive_system", "drive_type": "drive_system", "doors": "doors",
    "cylinders": "cylinders", "vin": "chassis_number", "chassis": "chassis_number",
    "mileage": "mileage", "year": "year", "engine_size": "engine_size",
    "chassis_number": "chassis_number", "warranty": "warranty",
    "chassis_condition": "chassis_condition", "horsepower": "horsepower", "seats": "seats",
    "steering_side": "steering_side", "origin": "origin",
}
ADVERT_LABELS = {
    "الكيلومتراج": "mileage", "المسافة المقطوعة": "mileage", "السنة": "year",
    "سنة الصنع": "year", "اللون الخارجي": "exterior_color", "اللون": "exterior_color",
    "اللون الداخلي": "interior_color", "الوقود": "fuel_type", "نوع الوقود": "fuel_type",
    "ناقل الحركة": "transmission", "الغيار": "transmission", "الحالة": "condition",
    "الشروط": "condition", "المحرك": "engine_size", "سعة المحرك": "engine_size",
    "سعة المحرك(سي سي)": "engine_size", "نوع الجسم": "body_type", "نظام الدفع": "drive_system",
    "نوع الدفع": "drive_system", "الأبواب": "doors", "عدد الأبواب": "doors",
    "السلندرات": "cylinders", "عدد السلندرات": "cylinders", "رقم الهيكل": "chassis_number",
    "الضمان": "warranty", "حالة الهيكل": "chassis_condition", "قوة الحصان": "horsepower",
    "المقاعد": "seats", "عدد المقاعد": "seats", "جهة القيادة": "steering_side",
    "الوارد": "origin",
}
DESCRIPTION_LABELS = {
    "نوع السيارة": "model", "الموديل": "model", "نوع الوقود": "fuel_type",
    "الوقود": "fuel_type", "ناقل الحركة": "transmission", "الغيار": "transmission",
    "نوع الغيار": "transmission", "اللون": "color", "اللون الخارجي": "color",
    "اللون الداخلي": "interior_color", "الحالة الفنية": "condition", "الحالة": "condition",
    "الشروط": "condition", "شروط": "condition", "نوع الهيكل": "body_type",
    "نوع الجسم": "body_type", "سعة المحرك": "engine", "المحرك": "engine",
    "سنة الصنع": "year", "السنة": "year", "المسافة المقطوعة": "mileage",
    "الكيلومتراج": "mileage", "عدد الأبواب": "doors", "عدد الابواب": "doors",
    "نظام الدفع": "drive_system", "نوع الدفع": "drive_system", "السلندرات": "cylinders",
    "عدد السلندرات": "cylinders",
}
FEATURE_SECTIONS = {
    "الميزات الداخلية": "interior_features", "الميزات الخارجية": "exterior_features",
    "الترفيه والشاشة": "entertainment_features",
}
