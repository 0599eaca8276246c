"""Data literals that decide results. Every one can be overridden by an argument of the operator using it."""

# --- channels -------------------------------------------------------------------------------------------------------
APP_CHANNEL = "Jiwa+"                    # orders of the consumer app, left out of the outlet sales summaries
WALK_IN = "Walk In"
LISTED_PRODUCT_CHANNEL = "Sejuta Jiwa"   # an order holding at least one listed product

# payment name -> channel at ingestion (names with a space)
INGEST_CHANNELS = {
    "Go Food": "Go Food",
    "Grab Food": "Grab Food",
    "Shopee Food": "Shopee Food",
    "Jiwa+": "Jiwa+",
    "Grab Dine Out": "Grab Dine Out",
    "Tokopedia Go": "Tokopedia Go",
    "QPON": "Qpon",
}

# payment name -> channel in the daily summaries (names without a space; deliberately not the table above)
SUMMARY_CHANNELS = {
    "GoFood": "Go Food",
    "ShopeeFood": "Shopee Food",
    "GrabFood": "Grab Food",
}

# product ids that turn an order into LISTED_PRODUCT_CHANNEL
LISTED_PRODUCTS = [
    "1d2664fc-f2c4-4d63-93b0-0150c5bad9ca",
    "514f7f40-fcf1-4b24-a881-0e32a6e2da88",
    "b7a5bd88-cda9-4623-814a-734767026910",
    "134f7a5b-09a2-455c-8f70-93a01468131e",
    "b26ce832-29a4-46f7-be9f-e9f4d72c1dca",
    "64b0cc8b-88e4-498a-b5b5-ff093b5915e5",
    "2306edf4-9f70-4c79-88d9-2a836a292816",
    "9eef163d-fd2f-4e52-98e6-4593679a16b5",
    "9ea8be5c-8bc1-4f14-b564-5eb75a19d907",
    "a96b7a4e-b86d-4171-956b-77a09d1c54f9",
    "6b07599f-14f8-44f9-ab5b-4389bf7e82d1",
    "328e5672-48a1-4683-b65d-c4a45f344ca1",
    "baa1d6c2-7b48-40af-a6f3-b9e481f93e61",
    "3ab4aa05-f664-4eaf-ad7e-bdf643d421d4",
    "2fcb7dad-bd59-44c9-a846-1279f9840d37",
    "c038d0fa-a12a-4644-9bbb-3878b3064912",
    "4521dc51-b3d6-4493-814a-617fde292c04",
    "62701d95-4d24-449e-b0db-ea8994d00b62",
    "8f5fe78b-7d7c-46ed-9f5b-c9f8d195b60d",
    "44d2e817-8745-4cbf-aa36-d4abfc75aebf",
    "a26111f7-3aa5-48b0-a77b-2f952aab5eae",
    "74ee1eae-21b8-467a-828c-b59cf780d065",
    "a89893bf-9026-4a5c-9f0c-949c0f4539d7",
    "150c96b0-fe81-4835-b3cc-593bfb6c45db",
    "999251a7-5e8b-4267-b67c-b33cedead904",
    "0c8a73fe-ae1b-4287-a6af-7d48fce86de5",
    "c9d038f6-fea1-494f-813c-ad0aed0dde1e",
    "a94730e0-4f5b-4af9-b70b-68dbea299b78",
    "5842673c-8a8b-423b-9804-1c0d484c60ac",
    "bae1b783-e862-4c5f-bb46-b20bb7e02b63",
    "00295e2b-66bb-489f-9615-6e25676c8331",
    "d8a7f659-c1dd-448a-9110-688fd1105bf8",
    "47855957-b056-49bc-8be3-c8ea68e0160b",
    "5864c6dc-216e-4764-9c8b-71bc9d77c41a",
    "3ffe31ac-f4c6-4206-959f-26f2ec6224fc",
    "64b5deb0-fcef-412f-bd2e-714a9b65a6b9",
    "7ddc0da7-72bf-4518-ac37-c1c62e48d418",
    "7fed141a-8b22-4cee-80c0-df4242e136ec",
    "5faac2db-7827-4414-a5ac-1345a79299dd",
    "06aa6648-b40a-4d02-b9b7-3105fa83c762",
    "75882846-f8ce-40a1-8405-031dfe2499c2",
]

# --- landlord income ------------------------------------------------------------------------------------------------
# raw payment name -> official payment type (looked up trimmed and case-insensitively)
PAYMENT_TYPES = {
    "Cash": "Cash",
    "BRI": "BRI",
    "Go Food": "Go Food",
    "Grab Food": "Grab Food",
    "Grab Dine Out": "Grab Dine Out",
    "Shopee Food": "Shopee Food",
    "Tokopedia Go": "Tokopedia Go",
    "Jiwa+": "Jiwa+",
    "iSellerpay (Sejutajiwariders)": "iSeller QRIS",
    "iSeller Pay QRIS": "iSeller QRIS",
    "isellerpay_qris": "iSeller QRIS",
    "Mandiri QRIS": "Mandiri QRIS",
    "QPON": "QPON",
}
UNKNOWN_PAYMENT_TYPE = "Unknown"

# official payment type -> share of the subtotal kept as commission
COMMISSION_RATES = {
    "Cash": 0.0,
    "BRI": 0.0,
    "Go Food": 0.16,
    "Grab Food": 0.15,
    "Grab Dine Out": 0.15,
    "Shopee Food": 0.15,
    "Tokopedia Go": 0.07,
    "Jiwa+": 0.0,
    "iSeller QRIS": 0.007,
    "Mandiri QRIS": 0.0,
    "QPON": 0.05,
}

# payment names sent to the landlord under one label
QRIS_ALIASES = ["iSeller Pay QRIS", "iSellerpay (Sejutajiwariders)"]
QRIS_LABEL = "iSeller QRIS"

# payment type -> dashboard column, in display order; anything else is "other"
DASHBOARD_BUCKETS = {
    "Cash": "cash",
    "BRI": "bri",
    "Go Food": "go_food",
    "Grab Food": "grab_food",
    "Grab Dine Out": "grab_dine_out",
    "Shopee Food": "shopee_food",
    "Tokopedia Go": "tokopedia_go",
    "Jiwa+": "jiwaplus",
    "iSeller QRIS": "iseller_qris",
    "iseller_qris": "iseller_qris",
    "isellerpay_qris": "iseller_qris",
    "iSeller Pay QRIS": "iseller_qris",
    "QPON": "qpon",
}
OTHER_BUCKET = "other"

MAX_PAYLOAD_NUMBER = 50

# --- details --------------------------------------------------------------------------------------------------------
DETAIL_TYPES = ["standard", "variant", "comboset"]
BUNDLE_TYPE = "comboset"
DETAIL_KEY = [
    "order_id", "order_detail_id", "type", "bundling_id", "product_id",
    "sku", "status", "payment_status", "transactions_type",
]
BUNDLE_GROUP_KEY = ["order_id", "order_detail_id", "bundling_id", "status", "payment_status", "transactions_type"]

# --- company-wide ---------------------------------------------------------------------------------------------------
FRANCHISE_MODEL = "MITRA"
OWNED_MODEL = "KBN"
SOURCE_LABELS = ["MOKA", "JIWA+", "ARTHAPOS", "ISELLER"]

# --- riders ---------------------------------------------------------------------------------------------------------
TEST_HUB = "HB-TESTING"
TEST_OUTLET = "JILID-TESTING"
DUMMY_PHONE = "628123456789"
EXTRA_RIDER_PREFIXES = ["BLITZ", "HMS"]
EARTH_RADIUS_M = 6371000.0
