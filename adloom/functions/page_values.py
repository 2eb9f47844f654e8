"""Fixed values of page extraction: where each kind of page keeps its fields, and words that name things."""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    """``level`` is page or card; ``take`` is text or an attribute; ``nth`` counts from 0 (negative from the
    end). Of several rules for a field the first non-empty one wins."""

    source: str
    level: str
    field: str
    tag: str = ""
    classes: str = ""
    attribute: str = ""
    within: str = ""
    take: str = "text"
    nth: int = 0


# Where each kind of page keeps its fields, and what a card is.
RULES = [
    Rule("generic", "page", "title_raw", "h1"),
    Rule("portal", "page", "title_raw", "h1", "single-listing-title"),
    Rule("portal", "page", "price_raw", "", "single-listing-price-value"),
    Rule("portal", "page", "views_raw", "", "stm-listing-views-count"),
    Rule("portal", "page", "views_raw", "", "*views*"),
    Rule("portal", "page", "description_raw", "", "stm-listing-description"),
    Rule("portal", "page", "description_raw", "", "single-listing-description"),
    Rule("portal", "page", "description_raw", "", "*description-content*"),
    Rule("portal", "page", "seller_name", "", "single-listing-dealer-name"),
    Rule("portal", "page", "dealer_link", "a", "single-listing-dealer-name", take="href"),
    Rule("portal", "page", "dealer_link", "a", "", "href", "single-listing-dealer-name", "href"),
    Rule("portal", "page", "phone", "span", "single-listing-phone-number"),
    Rule("portal", "page", "phone_link", "a", "single-listing-phone-button", take="href"),
    Rule("portal", "page", "whatsapp_link", "a", "single-listing-whatsapp-button", take="href"),
    Rule("grid", "page", "seller_name", "span", "text-primary font-semibold"),
    Rule("grid", "page", "city_path", "div", "text-xs font-semibold text-gray-500"),
    Rule("accordion", "page", "description_raw", "div", "description-car-details"),
    Rule("accordion", "page", "description_raw", "div", "car-description"),
    Rule("accordion", "page", "description_raw", "div", "notes-section"),
    Rule("accordion", "page", "description_raw", "h1", "sub-container-title"),
    Rule("accordion", "page", "dated", "div", "box-banner-car-view-date"),
    Rule("accordion", "page", "city", "span", "text-details-4"),
    Rule("accordion", "page", "mileage", "span", "text-details-3"),
    Rule("accordion", "page", "phone_link", "a", "", "id=direct-call", take="href"),
    Rule("accordion", "page", "listing_code", "span", "span-copy-id-code"),
    Rule("accordion", "page", "seller_name", "p", within="div-box-border-username"),
    Rule("accordion", "page", "seller_type", "span", "span-seller-details-1"),
    Rule("accordion", "page", "seller_listings", "span", "span-seller-details-2"),
    Rule("grid", "card", "*", "a", "", "data-ad-id"),
    Rule("grid", "card", "make_model", "span", "bg-custom_light_gray"),
    Rule("grid", "card", "mileage", "span", "bg-very_light_blue"),
    Rule("grid", "card", "year", "span", "bg-very_light_yellow"),
    Rule("grid", "card", "transmission", "span", "bg-very_light_green"),
    Rule("grid", "card", "ad_title", "h2"),
    Rule("grid", "card", "city", "span", "font-medium text-xs"),
    Rule("grid", "card", "price", "span", "text-*_blue"),
    Rule("grid", "card", "description", "p", "absolute"),
    Rule("grid", "card", "cover_image_url", "img", within="basis-[28%]", take="src"),
    Rule("portal", "card", "*", "div", "stm-isotope-listing-item", "data-listing-id"),
    Rule("portal", "card", "car_url", "a", "", "href", take="href"),
    Rule("portal", "card", "time_attr", "time", "", "datetime", take="datetime"),
    Rule("portal", "card", "time_text", "time", "", "datetime"),
    Rule("accordion", "card", "*", "div", "car-card"),
    Rule("accordion", "card", "car_url", "button", "sharing", take="data-link"),
    Rule("accordion", "card", "car_url", "button", "share-button", take="data-link"),
    Rule("accordion", "card", "car_url", "a", "", "href", take="href"),
    Rule("accordion", "card", "id", "button", "bookmark", take="data-car-id"),
    Rule("accordion", "card", "make", "h1", "car-title"),
    Rule("accordion", "card", "subtitle", "h2", "car-sub-title"),
    Rule("accordion", "card", "mileage", "p", within="features-a"),
    Rule("accordion", "card", "mileage", "div", within="features-a"),
    Rule("accordion", "card", "city", "span", within="features-a", nth=-1),
    Rule("accordion", "card", "city", "div", within="features-a", nth=1),
    Rule("accordion", "card", "fuel_type", "span", within="features-b"),
    Rule("accordion", "card", "fuel_type", "div", within="features-b"),
    Rule("accordion", "card", "origin", "span", within="features-b", nth=1),
    Rule("accordion", "card", "origin", "div", within="features-b", nth=1),
    Rule("accordion", "card", "transmission", "span", within="features-c"),
    Rule("accordion", "card", "transmission", "div", within="features-c"),
    Rule("accordion", "card", "condition", "span", within="features-c", nth=1),
    Rule("accordion", "card", "condition", "div", within="features-c", nth=1),
    Rule("accordion", "card", "price", "button", "", "id=request-price"),
    Rule("accordion", "card", "price", "button", "btn-contact-p"),
    Rule("tiles", "card", "*", "div", "product"),
    Rule("tiles", "card", "price_raw", "div", "text-orange"),
    Rule("tiles", "card", "الماركة", "span", "bg-purple"),
    Rule("tiles", "card", "الفئة", "span", "bg-purple", nth=1),
    Rule("tiles", "card", "title_raw", "h5", "product-title"),
    Rule("tiles", "card", "place", "div", "text-muted"),
    Rule("tiles", "card", "whatsapp_link", "a", "btn-whatsapp", take="href"),
    Rule("columns", "card", "*", "div", "card"),
    Rule("columns", "card", "الماركة", "h5"),
    Rule("columns", "card", "الموديل", "h6"),
    Rule("columns", "card", "title_raw", "h6", "text-primary"),
    Rule("columns", "card", "price_raw", "span", "text-success"),
    Rule("columns", "card", "location_raw", "div", "col-12", within="col-6"),
    Rule("columns", "card", "الكيلومترات", "div", "col-12", within="col-6", nth=1),
    Rule("columns", "card", "السنة", "div", "col-12", within="col-6", nth=2),
    Rule("columns", "card", "ناقل الحركة", "div", "col-12", within="col-6", nth=3),
    Rule("columns", "card", "نوع الوقود", "div", "col-12", within="col-6", nth=4),
    Rule("dealers", "card", "*", "tr", "stm-single-dealer"),
    Rule("dealers", "card", "dealer_name", "a", within="title"),
    Rule("dealers", "card", "profile_url", "a", within="title", take="href"),
    Rule("dealers", "card", "cars_count", "", "dealer-labels heading-font"),
    Rule("dealers", "card", "phone_masked", "", "phone heading-font"),
    Rule("dealers", "card", "location", "", "dealer-location-label"),
    Rule("dealers", "card", "dealer_id", "span", "stm-show-number", take="data-id"),
]

# Words by which headings, prices and sellers are recognised.
INFO_HEADING = "معلومات"
PRICE_MARKS = "\\$|دولار|USD"
DESCRIPTION_HEADINGS = ["وصف", "تفاصيل", "ملاحظات"]
SELLER_HEADINGS = ["بائع", "معلن", "المالك", "صاحب"]
SELLER_NOT_NAMES = [
    "المعلن", "البائع", "المالك", "صاحب الإعلان", "زيارة", "حساب تجاري", "حساب شخصي", "حساب وكالة",
]
SELLER_NOT_BEGINNINGS = ["إعلان", "حساب"]
NOTES_HEADING = "ملاحظات|sellers?.?note"
NO_NOTES = ["غير معروف", "N/A", "n/a", "-"]
SAFETY_WORDS = ["أمان", "سلامة", "safety"]
FEATURE_WORDS = ["مواصفات", "ميزات", "المواصفات", "الخارجية", "الراحة", "التقنية"]

# Class names of spec rows, lists, seller boxes, galleries and chapters.
SPEC_CLASSES = "spec|detail|feature|info|prop"
LIST_CLASSES = {
    "generic": r"accordion-\d+-content-details|accordion-inner-details",
    "accordion": "box-accordion-1-(?:right|left)",
}
LIST_WORD = "accordion-"  # in all of them
SELLER_CLASSES = "box-container-seller-info|seller-info-box|seller-details"
FEATURE_CLASSES = "box-accordion-(?!1)"
FEATURE_WORD = "box-accordion-"  # what these begin with
DATA_ITEM = "single-listing-data-item"
CHAPTER = "single-listing-chapter-title"
GALLERY_IMAGE, ALBUM, CAR_IMAGE = "single-listing-gallery-image", "container-images-album", "car-image"

# Limits that tell a label, a price or a seller name from running text.
MAX_LABEL = 40
MAX_PRICE = 49
MAX_SELLER = 100
