"""Fixed values of the clinic rule set.

These are the constants a run must use to reproduce the clinic table: weights,
BIN codes, prices, formats and rewrite rules. Ordered dictionaries keep their
insertion order because the weighted pick scans them cumulatively in that order.
"""

# fixed values: passport country distribution (ordered)
COUNTRY_WEIGHTS = [("ru", 0.80), ("by", 0.12), ("kz", 0.08)]
COUNTRY_DEFAULT = "ru"

# fixed values: bank distribution (ordered)
BANK_WEIGHTS = [
    ("sberbank", 0.40),
    ("vtb", 0.20),
    ("alfabank", 0.15),
    ("tinkoff", 0.10),
    ("gazprombank", 0.08),
    ("raiffeisen", 0.07),
]
BANK_DEFAULT = "sberbank"

# fixed values: payment system distribution (ordered)
SYSTEM_WEIGHTS = [("mir", 0.50), ("visa", 0.30), ("mastercard", 0.20)]
SYSTEM_DEFAULT = "mir"

# fixed values: BIN codes (first 6 card digits) by bank and payment system
BANK_BINS = {
    "sberbank": {
        "mir": ["220004", "220005", "220007"],
        "visa": ["427683", "427901", "427644"],
        "mastercard": ["548673", "546938", "510126"],
    },
    "vtb": {
        "mir": ["220002", "220003"],
        "visa": ["447520", "415374"],
        "mastercard": ["532301", "510020"],
    },
    "alfabank": {
        "mir": ["220006"],
        "visa": ["462729", "415428"],
        "mastercard": ["510043", "548699"],
    },
    "tinkoff": {
        "mir": ["220014"],
        "visa": ["437772", "521324"],
        "mastercard": ["553691", "548701"],
    },
    "gazprombank": {
        "mir": ["220008"],
        "visa": ["463027"],
        "mastercard": ["510002"],
    },
    "raiffeisen": {
        "mir": ["220009"],
        "visa": ["462204"],
        "mastercard": ["510003"],
    },
}

# fixed values: price of an analysis by its exact name
ANALYSIS_PRICES = [
    ("общий анализ крови", 800),
    ("биохимический анализ крови", 1500),
    ("общий анализ мочи", 600),
    ("мазок на ковид", 2000),
    ("рентген грудной клетки", 2500),
    ("эко кг", 3000),
    ("узи брюшной полости", 2800),
    ("флюорография", 1200),
    ("анализ на сахар", 400),
    ("анализ на холестерин", 500),
]

# fixed values: other analyses by a word inside the name (words, class), first match wins
PRICE_KEYWORDS = [
    (("кровь", "крови"), "кровь"),
    (("моча", "мочи"), "моча"),
    (("мазок",), "мазок"),
    (("рентген", "рентгена"), "рентген"),
    (("узи",), "узи"),
    (("мрт", "томография"), "мрт"),
    (("кт",), "кт"),
]

# fixed values: price ranges of the classes; the middle of the range is the price
PRICE_RANGES = {
    "кровь": (300, 3000),
    "моча": (400, 1500),
    "мазок": (800, 2500),
    "рентген": (1500, 4000),
    "узи": (2000, 5000),
    "мрт": (8000, 15000),
    "кт": (6000, 12000),
}

# fixed values: price of an analysis that no rule names
PRICE_DEFAULT = 1750

# fixed values: passport formats by country
PASSPORT_PATTERNS = [
    ("ru", r"^[0-9]{4} [0-9]{6}$"),
    ("by", r"^[A-Z]{2}[0-9]{7}$"),
    ("kz", r"^N[0-9]{8}$"),
]
BY_PREFIXES = ["AB", "BM", "HB", "KB", "MP", "MC", "PP"]
KZ_PREFIX = "N"
RU_NEW_FORM_DATE = "1997-10-01"
DEPT_CODE_PATTERN = r"^[0-9]{3}-[0-9]{3}$"

# fixed values: passport regions (code, weight), ordered; weights sum to 1.04
RU_REGIONS = [
    (77, 0.15),
    (50, 0.08),
    (78, 0.08),
    (47, 0.04),
    (23, 0.06),
    (61, 0.05),
    (66, 0.05),
    (54, 0.04),
    (2, 0.04),
    (16, 0.04),
    (52, 0.04),
    (74, 0.04),
    (63, 0.04),
    (59, 0.03),
    (38, 0.03),
    (72, 0.03),
    (36, 0.03),
    (34, 0.03),
    (42, 0.03),
    (39, 0.02),
    (1, 0.01),
    (3, 0.01),
    (4, 0.01),
    (5, 0.01),
    (6, 0.01),
    (7, 0.01),
    (8, 0.01),
    (9, 0.01),
    (10, 0.01),
]
RU_REGION_DEFAULT = 77

# fixed values: client age tiers (lo, hi inclusive, weight)
AGE_TIERS = [(18, 24, 1), (25, 45, 3), (46, 65, 2), (66, 80, 1)]

# fixed values: female surname endings (suffix, characters to strip, ending to add),
# first match wins; the last two keep the surname as it is
FEMALE_SURNAME_RULES = [
    ("ов", 2, "ова"),
    ("ев", 2, "ева"),
    ("ин", 2, "ина"),
    ("ский", 4, "ская"),
    ("ук", 0, ""),
    ("юк", 0, ""),
]

# fixed values: probabilities, limits and sizes
CLIENT_REPEAT_PROBABILITY = 0.75
CLIENT_POOL_MIN = 50
CARD_REUSE_PROBABILITY = 0.40
CARD_REUSE_LIMIT = 5
PATH_BY_GENDER_PROBABILITY = 0.80
SPECIALIST_ONE_MATCH_PROBABILITY = 0.70
DEFAULT_ON_NO_MATCH_PROBABILITY = 0.80
SYMPTOMS_PER_VISIT = (1, 3)
ANALYSES_PER_VISIT = (1, 2)
ANALYSES_MAX = 5
DATASET_MIN_ROWS = 50_000
DICT_MIN_SYMPTOMS = 5000
DICT_MIN_DOCTORS = 50
DICT_MIN_ANALYSES = 250
COST_SUFFIX = " руб."
