"""Row layouts. Column orders are fixed values: sinks must write exactly these."""

from __future__ import annotations

COLUMNS: dict[str, list[str]] = {
    "unified": [
        "scraped_at", "source", "id", "category", "images", "listing_type", "condition",
        "body_type", "brand", "model", "price", "location", "year", "transmission", "fuel_type",
        "mileage", "engine", "cylinders", "color", "interior_color", "doors", "vin",
        "description", "seller_name", "contact", "drive_system", "ad_title",
    ],
    "classified_raw": [
        "id", "source", "car_url", "listing_id", "ad_title", "listing_type", "condition",
        "body_type", "status", "make", "model", "year", "exterior_color", "interior_color",
        "fuel_type", "engine_size", "cylinders", "transmission", "drive_system", "origin",
        "specifications", "city", "mileage", "price", "date_added", "scraped_at", "views",
        "featured", "phone", "seller_name", "description", "image_urls", "image_count",
    ],
    "classified_wide": [
        "scraped_at", "date_added", "source", "id", "category", "ad_title", "listing_type",
        "condition", "body_type", "brand", "model", "price", "location", "year", "drive_system",
        "transmission", "fuel_type", "mileage", "engine", "cylinders", "color",
        "interior_color", "doors", "vin", "description", "seller_name", "contact", "images",
        "image_folder_url", "images_original_links", "car_url",
    ],
    "advert_raw": [
        "id", "source", "car_url", "listing_id", "slug", "ad_title", "listing_type", "make",
        "model", "year", "condition", "exterior_color", "fuel_type", "engine_size",
        "transmission", "city", "mileage", "price", "date_added", "scraped_at", "phone",
        "seller_name", "description", "cover_image_url", "image_clean_link",
    ],
    "advert_wide": [
        "id", "source", "car_url", "make", "model", "year", "body_type", "exterior_color",
        "interior_color", "fuel_type", "engine_size", "cylinders", "horsepower",
        "transmission", "doors", "seats", "steering_side", "origin", "condition",
        "chassis_condition", "warranty", "chassis_number", "city", "mileage", "price",
        "date_added", "views", "phone", "listing_id", "seller_name", "seller_type",
        "seller_listings", "description_original", "images_original_links",
        "images_drive_links",
    ],
    "portal_raw": [
        "id", "source", "car_url", "listing_id", "ad_title", "listing_type", "make", "model",
        "year", "body_type", "condition", "exterior_color", "interior_color", "fuel_type",
        "engine_size", "transmission", "drive_system", "cylinders", "doors",
        "chassis_number", "city", "mileage", "price", "date_added", "scraped_at", "views",
        "phone", "seller_name", "seller_type", "seller_notes", "description", "image_urls",
        "image_count",
    ],
    "portal_wide": [
        "id", "source", "car_url", "make", "model", "year", "body_type", "exterior_color",
        "interior_color", "fuel_type", "engine_size", "transmission", "condition", "city",
        "mileage", "price", "date_added", "views", "phone", "listing_id", "seller_name",
        "seller_type", "seller_notes", "images_drive_links", "drive_system",
        "image_clean_link",
    ],
    "grid_raw": [
        "id", "source", "car_url", "listing_id", "ad_title", "listing_type", "make", "model",
        "year", "condition", "exterior_color", "fuel_type", "engine_size", "engine_power",
        "transmission", "body_type", "drive_system", "warranty", "seller_type", "city",
        "mileage", "price", "date_added", "scraped_at", "phone", "seller_name",
        "description", "interior_features", "exterior_features", "entertainment_features",
        "cover_image_url", "image_clean_link",
    ],
    "dealers": [
        "dealer_name", "username", "profile_url", "phone", "city", "car_count", "scraped_at",
    ],
    "dealer_directory": [
        "scraped_at", "dealer_name", "cars_count", "phone", "phone_masked", "location",
        "profile_url", "dealer_id",
    ],
}
_wide = COLUMNS["advert_wide"]
_at = _wide.index("images_original_links")
COLUMNS["accordion_wide"] = _wide[:_at] + ["features", "safety_features"] + _wide[_at:]

SPECS = "array<struct<pos:int,label:string,value:string>>"

RAW_CARD = (
    "source string, id string, scraped_at string, listing_type string, title_raw string, "
    "price_raw string, location_raw string, description_raw string, category string, "
    f"ad_url string, ad_id string, specs {SPECS}, images array<string>, phone string, "
    "whatsapp string, seller_name string, posted_date string"
)
RAW_DETAIL = (
    "title_raw string, price_raw string, description_raw string, seller_name string, "
    f"phone string, whatsapp string, specs {SPECS}, images array<string>"
)
WEBSITE = (
    "id string, name string, description string, url string, type string, scraper_class string, "
    "scraper_file string, google_sheet_id string, enabled boolean, priority int, "
    "image_folder string, scheduling struct<enabled:boolean,frequency:string,day:string,"
    "time:string>, last_run string, total_items int, last_run_count int"
)
CATALOG = (
    "id string, name string, description string, url string, type string, scraper_class string, "
    "scraper_file string, google_sheet_id string, enabled boolean, priority int, "
    "image_folder string, scheduling_enabled boolean, scheduling_frequency string, "
    "scheduling_day string, scheduling_time string, last_run timestamp, total_items int, "
    "last_run_count int, last_run_status string, created_at timestamp, updated_at timestamp"
)
JOBS = (
    "id string, website_id string, user_id int, started_at timestamp, completed_at timestamp, "
    "duration_seconds double, items_count int, items_new int, items_duplicate int, "
    "status string, error_message string, sheets_written boolean"
)
STATISTICS = (
    "id string, website_id string, stat_date timestamp, total_items int, items_added int, "
    "category_data string, price_stats string, year_range string, raw_statistics string, "
    "created_at timestamp"
)
AUDIT = (
    "id string, user_id int, action string, resource_type string, resource_id string, "
    "details string, ip_address string, user_agent string, created_at timestamp"
)
IMAGE_META = "id string, idx int, url string, width int, height int, brightness double"
UNKNOWN_VALUES = "field string, value string"
