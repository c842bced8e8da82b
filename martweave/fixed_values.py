"""Word lists, thresholds and lookup tables that results depend on.

Everything here is data, kept in one place and in natural order.  Code elsewhere
reads these names and holds no literal business constants of its own.
"""

# --- spend monitoring --------------------------------------------------------

REQUIRED_TRANSACTION_FIELDS = [
    "transaction_id",
    "company_id",
    "vendor_id",
    "vendor_category",
    "vendor_risk_tier",
    "amount_usd",
    "timestamp",
    "baseline_monthly_spend",
    "company_size_tier",
]

# Position in the list is the model's integer code.
VENDOR_CATEGORIES = [
    "saas_software",
    "travel",
    "office_supplies",
    "payroll_services",
    "advertising_marketing",
    "professional_services",
    "logistics_shipping",
    "telecom_internet",
    "facilities_utilities",
    "hardware_equipment",
]

FEATURE_NAMES = [
    "amount_usd",
    "amount_to_baseline_ratio",
    "log_amount",
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "is_high_risk_vendor",
    "vendor_category_encoded",
]

EXPECTED_SHARE_OF_BASELINE = 0.01
SPEND_SPIKE_MULTIPLIER = 5.0
HIGH_RISK_VENDOR_AMOUNT = 5000.0
OFF_HOURS = (0, 5)
ROUND_AMOUNT_FLOOR = 5000.0
ROUND_AMOUNT_STEP = 1000.0

RAW_SCORE_BOUNDS = (-0.5, 0.1)
RULE_CONTRIBUTION = 0.2
RULE_CONTRIBUTION_CAP = 0.4
RISK_FLAG_AT = 0.5

RISK_TIER = [(0.5, "high"), (0.3, "medium")]
RISK_TIER_DEFAULT = "low"

ALERT_REASONS = [
    ("rule_spend_spike", "spend spike; "),
    ("rule_high_risk_vendor", "high-risk vendor; "),
    ("rule_off_hours", "off-hours transaction; "),
    ("rule_round_amount", "suspiciously round amount; "),
]
ALERT_MODEL_ONLY = "ML anomaly (no rule triggered); "
ALERT_MODEL_SCORE = 0.4

UNUSUAL_DAY_FACTOR = 3
ROLLING_ROWS = 7

VENDOR_HIGH_RATE = 0.3
VENDOR_MEDIUM_RATE = 0.1

SPEND_WINDOW = "5 minutes"

RETRAIN_MIN_ROWS = 500
RETRAIN_EPOCH = "2000-01-01T00:00:00+00:00"

FOREST_TREES = 100
FOREST_SAMPLE = 256
FOREST_CONTAMINATION = 0.01
FOREST_SEED = 42

# --- marketplace ---------------------------------------------------------------

DELIVERY_OPEN = "In Progress / Unfulfilled"
DELIVERY_ON_TIME = "On Time / Early"
DELIVERY_LATE = "Delayed"
CHANNEL_UNKNOWN = "unknown"
CHANNEL_ORGANIC = "organic_platform"

ORDER_STATUSES = [
    "created",
    "approved",
    "processing",
    "invoiced",
    "shipped",
    "delivered",
    "canceled",
    "unavailable",
]

MARKETING_CHANNELS = [
    "organic_platform",
    "organic_search",
    "paid_search",
    "unknown",
    "direct_traffic",
    "social",
    "referral",
    "email",
    "other",
    "display",
]

# --- customers -------------------------------------------------------------------

DAILY_STATUSES = ["completed", "pending", "cancelled", "returned", "shipped"]

# --- hotel -------------------------------------------------------------------------

HOTEL_KINDS = ["Resort Hotel", "City Hotel"]
NO_DEPOSIT = "No Deposit"
LATE_CANCELLATION_DAYS = 7

STAY_POINTS = [(50, 100), (20, 50), (10, 20), (5, 10)]
REPEAT_GUEST_POINTS = 100
CANCELLATION_PENALTY = -50
ROOM_POINTS = [(["A"], 500), (["B", "C"], 250), (["D", "E", "F"], 200), (["G", "H"], 100)]
RATE_POINTS = [(2500, 2500), (1000, 1000), (500, 750), (100, 210), (50, 10)]
RESERVATION_POINTS = [(["Canceled"], -250), (["Check-Out"], 100), (["No-Show"], -50)]
REVENUE_POINTS = [
    (5000, 3000),
    (3500, 2000),
    (3000, 1800),
    (2500, 1500),
    (1000, 1000),
    (500, 750),
    (250, 500),
]
LOYAL_TIERS = [(3000, "Elite"), (2700, "Diamond"), (2500, "Platinum")]
OPEN_TIERS = [
    (2500, "Gold"),
    (2000, "Silver"),
    (1000, "Bronze"),
    (500, "Copper"),
    (250, "Iron"),
]
TIER_DEFAULT = "Standard"

# inclusive lead-time bands in days; None is open
LEAD_BANDS = [
    ("booked_last_week", None, 6),
    ("booked_1_to_4_weeks", 7, 30),
    ("booked_1_to_3_months", 31, 90),
    ("booked_3_to_6_months", 91, 180),
    ("booked_6_months_plus", 181, None),
]

# --- commerce events and orders ------------------------------------------------

EVENT_TYPES = ["page_view", "add_to_cart", "remove_from_cart", "checkout_started", "purchase"]
EVENT_REQUIRED = ["type", "user_id", "session_id", "timestamp"]
DOC_ORDER_STATUSES = ["pending", "paid", "shipped", "delivered", "refunded", "cancelled"]
DOC_ORDER_REQUIRED = ["order_id", "user_id", "items", "totals", "status", "created_at"]
DEVICE_TYPES = ["mobile", "desktop", "tablet"]
TOPICS = ["events", "orders"]
TAX_RATE = 0.20
STATS_LOOKBACK_DAYS = 7
EVENT_RETENTION_DAYS = 90

# first group with a matching fragment wins
DEVICE_FRAGMENTS = [
    ("mobile", ["iphone", "android", "mobile", "fxios", "crios"]),
    ("tablet", ["ipad", "tablet"]),
]
DEVICE_DEFAULT = "desktop"
BROWSER_FRAGMENTS = [
    ("Firefox", ["firefox", "fxios"]),
    ("Edge", ["edg"]),
    ("Chrome", ["chrome", "crios"]),
    ("Safari", ["safari"]),
    ("Opera", ["opera", "opr"]),
    ("IE", ["msie", "trident"]),
]
BROWSER_DEFAULT = "Other"

# --- bank ledger -----------------------------------------------------------------

LEDGER_TYPES = [
    "deposit",
    "withdrawal",
    "purchase",
    "cheque deposit",
    "cheque withdrawal",
    "POS",
    "payment",
    "transfer",
]
MERCHANT_TYPES = ["purchase", "POS", "payment"]
EXTERNAL_PARTY = "external"
NO_PARTY = "NA"
FAIL_REASON = "Insufficient funds"
EXCHANGE_RATES = [("USD/EUR", "0.95"), ("EUR/USD", "1.05")]
ACCOUNT_TYPES = ["savings", "checking", "credit", "regular"]
STORED_TRANSACTION_TYPES = [
    "deposit",
    "withdrawal",
    "purchase",
    "cheque deposit",
    "cheque withdrawal",
    "charge",
    "POS",
    "payment",
    "transfer",
]
TRANSACTION_STATUSES = ["success", "failed"]
MERCHANT_KINDS = ["online", "retail", "restaurant", "service", "grocery", "other"]

# --- university ---------------------------------------------------------------------

GRADE_BANDS = [
    (90.0, "A", "4.0"),
    (87.0, "A-", "3.7"),
    (83.0, "B+", "3.3"),
    (80.0, "B", "3.0"),
    (77.0, "B-", "2.7"),
    (73.0, "C+", "2.3"),
    (70.0, "C", "2.0"),
    (67.0, "C-", "1.7"),
    (63.0, "D+", "1.3"),
    (60.0, "D", "1.0"),
]
GRADE_FAIL = ("F", "0.0")
GRADE_GROUPS = [
    ("a_share", ["A", "A-"]),
    ("b_share", ["B+", "B", "B-"]),
    ("c_share", ["C+", "C", "C-"]),
    ("d_share", ["D+", "D"]),
]

COLLEGES = ["CBAS", "CHSS", "CBE", "CHSP"]
# college -> credits needed, cost per compulsory credit, cost per elective credit
COLLEGE_CREDITS = {"CBAS": 80, "CHSS": 70, "CBE": 75, "CHSP": 80}
COLLEGE_CREDIT_COST = {
    "CBAS": (1300, 1250),
    "CHSS": (1500, 1400),
    "CBE": (1400, 1200),
    "CHSP": (1350, 1250),
}
UNKNOWN_COLLEGE = "Unknown"

COLLEGE_DEPARTMENTS = {
    "CBAS": [
        "Biology", "Chemistry", "Physics", "Mathematics", "Computer Science", "Geology",
        "Environmental Science", "Mechanical Engineering", "Electrical Engineering",
        "Civil Engineering", "Chemical Engineering", "Aerospace Engineering",
        "Industrial Engineering", "Materials Science", "Agriculture", "Forestry",
        "Food Science", "Horticulture", "Animal Science", "Marine Biology", "Oceanography",
        "Meteorology", "Space Sciences", "Astrophysics", "Genetics", "Biomedical Engineering",
        "Biochemistry", "Cell Biology", "Immunology", "Neurology", "Microbiology",
        "Pharmacology", "Pathology", "Radiology", "Surgery", "Anesthesiology", "Pediatrics",
        "Obstetrics and Gynecology", "Psychiatry", "Dermatology", "Oncology",
        "Emergency Medicine", "Architecture",
    ],
    "CHSS": [
        "Psychology", "Sociology", "History", "English", "Philosophy", "Anthropology",
        "Linguistics", "Music", "Art History", "Theater and Dance", "Film Studies",
    ],
    "CBE": [
        "Economics", "Business Administration", "Marketing", "Finance", "Accounting",
        "Human Resource Management", "International Relations",
    ],
    "CHSP": [
        "Nutrition", "Public Health", "Social Work", "Law", "Medicine", "Nursing", "Pharmacy",
        "Dentistry", "Veterinary Medicine", "Political Science", "Education",
    ],
}

ENGINEERING_DEPARTMENTS = [
    "Mechanical Engineering", "Electrical Engineering", "Civil Engineering",
    "Chemical Engineering", "Aerospace Engineering", "Industrial Engineering",
    "Biomedical Engineering",
]

FACULTY_POSITIONS = ["Professor", "Associate Professor", "Assistant Professor", "Lecturer"]
HEAD_POSITION = "Head of Department"

HOUSING_TYPES = [
    "Studio Single",
    "Studio Double",
    "Dormitory Single",
    "Dormitory Double",
    "Dormitory Triple",
    "Dormitory Quad",
]
HOUSING_PENDING = "Pending"
HOUSING_EXTERNAL = "External Housing"
ROOM_STATUSES = ("Unoccupied", "Partially Occupied", "Fully Occupied")

STUDY_YEARS = {2025: 1, 2024: 2, 2023: 3}
