"""Given by the business rules, not chosen here.

Results depend on every one of them, so they are written out plainly.
"""

# Date of birth.
DOB_PLACEHOLDER = "1900-01-01"
DOB_SHAPES = (
    # (shape of the text, datetime pattern)
    (r"^\d{4}-\d{2}-\d{2}\z", "yyyy-MM-dd"),
    (r"^\d{4}/\d{2}/\d{2}\z", "yyyy/MM/dd"),
    (r"^\d{2}/\d{2}/\d{4}\z", "dd/MM/yyyy"),
)

# Customer type.
CORPORATE_PREFIXES = ("PT ", "CV ", "UD ")
CUSTOMER_TYPES = ("individual", "corporate")

# Price class, in rupiah, bounds included. An average of 250,000,000.5 lies in no class.
PRICE_BANDS = (
    # (class, from, to)
    ("LOW", 100_000_000, 250_000_000),
    ("MEDIUM", 250_000_001, 400_000_000),
)
PRICE_HIGH_ABOVE = 400_000_000
PRICE_CLASSES = ("LOW", "MEDIUM", "HIGH", "UNDEFINED")

# After-sales priority by number of services.
PRIORITY_HIGH_ABOVE = 10
PRIORITY_MED_FROM = 5
PRIORITIES = ("HIGH", "MED", "LOW")

# Address shown when any part of it is unknown.
NO_ADDRESS = "Alamat tidak tersedia"

# Service types.
SERVICE_TYPES = (
    # (code, name, description)
    ("BP", "Body Paint", "Perbaikan body dan cat kendaraan"),
    ("PM", "Periodic Maintenance", "Servis berkala rutin sesuai jadwal"),
    ("GR", "General Repair", "Perbaikan umum di luar jadwal berkala"),
)

# Calendar covered by the date dimension, both ends included.
CALENDAR_FROM = "2024-01-01"
CALENDAR_TO = "2027-12-31"

# Landing files.
LANDING_PIPELINE = "customer_addresses"
LANDING_GLOB = "customer_addresses_{}.{}"  # day, extension
LANDING_NAME = r"^customer_addresses_\d{8}\.csv\z"

# Texts that the CSV reader of the landing job takes for a missing value.
MISSING_TEXTS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
