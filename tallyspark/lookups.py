"""Reviewed lookup values: taxonomies, aliases, keyword sets and approved mappings.

Everything here is configuration that decides results, so it is kept as plain
text in one place.  The functions at the end turn it into Spark DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Taxonomy versions (id -> family).
TAXONOMY_V1 = {
    2001: "Dining",
    2002: "Fuel",
    2003: "Transport",
    2004: "Utilities & Bills",
    2005: "Healthcare",
    2006: "Shopping & Retail",
    2007: "Transfers & Withdrawals",
    2008: "Income",
    2009: "Groceries",
    2010: "Other",
}

TAXONOMY_V2 = {
    2001: "Food & Groceries",
    2002: "Fuel",
    2003: "Transport",
    2004: "Utilities & Bills",
    2005: "Healthcare",
    2006: "Shopping & Retail",
    2007: "Transfers & Withdrawals",
    2008: "Income",
    2009: "Other",
}

TAXONOMIES = {"v1": TAXONOMY_V1, "v2": TAXONOMY_V2}

# v1 id -> v2 id, the opt-in repair of ids that changed meaning.
CROSSWALK_V1_V2 = {
    2001: 2001,
    2002: 2002,
    2003: 2003,
    2004: 2004,
    2005: 2005,
    2006: 2006,
    2007: 2007,
    2008: 2008,
    2009: 2001,
    2010: 2009,
}

# Seed terms of the v1 taxonomy.
SEED_TERMS_V1 = {
    2001: [
        "food", "dinner", "lunch", "breakfast", "roti", "biryani", "pizza", "burger", "kfc",
        "foodpanda", "mcdonald", "mcdonalds", "restaurant", "meal", "khana",
    ],
    2002: ["petrol", "fuel", "diesel", "gasoline", "cng", "benzine", "petroleum"],
    2003: ["careem", "uber", "parking", "taxi", "toll", "toll tax"],
    2004: [
        "electricity", "electricity bill", "water bill", "gas bill", "ptcl", "cable", "utility",
        "bill",
    ],
    2005: ["medicine", "medicines", "doctor", "hospital", "medical", "clinic"],
    2006: ["shoes", "clothes", "clothing", "shopping", "flipkart", "daraz", "mall"],
    2007: [
        "cash", "atm", "transfer", "withdrawal", "withdrawl", "cash withdrawal",
        "cash withdrawl",
    ],
    2008: ["salary", "interest earned", "online deposit", "deposit", "income"],
    2009: [
        "sabzi", "vegetables", "vegetable", "doodh", "milk", "bread", "eggs", "egg", "fruit",
        "fruits", "grocery", "groceries", "kirana", "lauka", "karela", "bajra", "dahi", "yogurt",
    ],
    2010: [],
}

# Seed rows of the category dimension (id, name, description).
CATEGORY_SEED = [
    (2001, "Dining", "Food, restaurants and dining expenses"),
    (2002, "Fuel", "Fuel and petrol related transactions"),
    (2003, "Transport", "Transportation and travel expenses"),
    (2004, "Utilities", "Utility bills and household services"),
    (2005, "Healthcare", "Medical and healthcare expenses"),
    (2006, "Shopping", "Shopping and retail purchases"),
    (2007, "Transfers", "Money transfers and cash movements"),
    (2008, "Income", "Salary and other income"),
    (2009, "Groceries", "Grocery and household food purchases"),
]

# Alias -> v2 family, one table per consumer (they differ).
CASCADE_ALIASES = {
    "food": "Food & Groceries",
    "food & groceries": "Food & Groceries",
    "groceries": "Food & Groceries",
    "fuel": "Fuel",
    "transport": "Transport",
    "utilities": "Utilities & Bills",
    "utilities & bills": "Utilities & Bills",
    "utility": "Utilities & Bills",
    "healthcare": "Healthcare",
    "health": "Healthcare",
    "shopping": "Shopping & Retail",
    "shopping & retail": "Shopping & Retail",
    "retail": "Shopping & Retail",
    "transfers": "Transfers & Withdrawals",
    "transfers & withdrawals": "Transfers & Withdrawals",
    "transfer": "Transfers & Withdrawals",
    "income": "Income",
    "other": "Other",
}

TRAINING_ALIASES = {
    "food": "Food & Groceries",
    "food & groceries": "Food & Groceries",
    "groceries": "Food & Groceries",
    "grocery": "Food & Groceries",
    "dining": "Food & Groceries",
    "fuel": "Fuel",
    "transport": "Transport",
    "utilities": "Utilities & Bills",
    "utilities & bills": "Utilities & Bills",
    "healthcare": "Healthcare",
    "shopping": "Shopping & Retail",
    "shopping & retail": "Shopping & Retail",
    "transfers": "Transfers & Withdrawals",
    "transfers & withdrawals": "Transfers & Withdrawals",
    "income": "Income",
    "other": "Other",
}

CLASSIFIER_ALIASES = {
    "dining": "Food & Groceries",
    "groceries": "Food & Groceries",
    "food": "Food & Groceries",
    "food & groceries": "Food & Groceries",
    "fuel": "Fuel",
    "transport": "Transport",
    "utilities": "Utilities & Bills",
    "utilities & bills": "Utilities & Bills",
    "healthcare": "Healthcare",
    "shopping": "Shopping & Retail",
    "shopping & retail": "Shopping & Retail",
    "transfers": "Transfers & Withdrawals",
    "transfers & withdrawals": "Transfers & Withdrawals",
    "income": "Income",
    "other": "Other",
}

# Proposal families, their terms and v1 ids.
PROPOSAL_TERMS = {
    "Fuel": ["petrol", "fuel", "diesel", "gasoline", "cng", "benzine", "petroleum"],
    "Transfers": [
        "cash", "atm", "transfer", "withdrawal", "withdrawl", "cash withdrawal",
        "cash withdraw", "cash withdrawl",
    ],
    "Utilities": [
        "electricity", "utility", "water bill", "gas bill", "ptcl", "cable", "electricity bill",
    ],
    "Dining": [
        "lunch", "dinner", "breakfast", "roti", "biryani", "pizza", "burger", "kfc", "mcdonald",
        "restaurant", "food",
    ],
    "Groceries": [
        "grocery", "groceries", "milk", "doodh", "bread", "eggs", "egg", "fruit", "fruits",
        "vegetables", "vegetable", "sabzi", "kirana", "lauka", "karela", "bajra", "dahi",
    ],
    "Healthcare": [
        "medicine", "medicines", "doctor", "hospital", "medical", "clinic", "pharmacy",
    ],
    "Shopping": [
        "shoes", "clothes", "shopping", "clothing", "flipkart", "daraz", "store", "mall",
    ],
    "Income": ["salary", "interest earned", "online deposit", "income", "deposit"],
    "Transport": ["careem", "uber", "parking", "taxi", "toll", "toll tax", "rickshaw"],
}

PROPOSAL_IDS = {
    "Dining": 2001,
    "Fuel": 2002,
    "Transport": 2003,
    "Utilities": 2004,
    "Healthcare": 2005,
    "Shopping": 2006,
    "Transfers": 2007,
    "Income": 2008,
    "Groceries": 2009,
    "Other": 2010,
}

PROPOSAL_NOTE = (
    "Machine-generated proposal based on description and transaction type. "
    "No mapping has been applied."
)

# Multilingual synonym hints.
SYNONYMS = {
    "sabzi": "vegetables",
    "vegetables": "sabzi",
    "doodh": "milk",
    "milk": "doodh",
    "dahi": "yogurt",
    "roti": "bread",
    "lauka": "vegetable",
    "karela": "vegetable",
}

SYNONYM_NOTE = "Possible multilingual/synonym case. Review before approval."

# Keyword rules of the mapping cascade (substring match).
RULE_KEYWORDS = {
    "Fuel": [
        "petrol", "gas station", "fuel station", "petroleum", "shell", "pso", "parco", "hascol",
        "attock", "caltex", "cng",
    ],
    "Transport": ["uber", "careem", "indrive", "yango", "bykea", "taxi", "ride", "transport"],
    "Utilities & Bills": [
        "electricity", "electric bill", "gas bill", "water bill", "utility bill", "utilities",
        "k-electric", "k electric", "ssgc", "sngpl", "ptcl", "internet bill", "phone bill",
        "zong internet", "jazz internet", "telenor internet",
    ],
    "Healthcare": [
        "hospital", "clinic", "pharmacy", "medical", "medicine", "doctor", "laboratory", "lab",
        "healthcare",
    ],
    "Shopping & Retail": [
        "daraz", "amazon", "shopping", "clothing", "clothes", "mall", "retail",
    ],
    "Food & Groceries": [
        "kfc", "mcdonald", "pizza", "restaurant", "food", "grocery", "groceries", "bakery",
        "cafe", "foodpanda", "cheezious", "subway", "lunch", "dinner", "breakfast", "nashta",
        "roti", "bread", "eggs", "milk", "chicken", "fruits", "fruit", "vegetables", "sabzi",
        "biryani", "juice", "mango", "mangoes", "tea", "chai", "dahi", "snacks", "cake",
    ],
    "Income": ["salary", "wages", "payroll", "income", "bonus"],
    "Transfers & Withdrawals": [
        "transfer", "withdrawal", "atm cash", "cash withdrawal", "funds transfer",
        "credit card payment",
    ],
}

# Keyword groups of the unresolved-rows diagnosis (substring match).
DIAGNOSTIC_KEYWORDS = {
    "Food": [
        "food", "restaurant", "grocery", "groceries", "mart", "bakery", "cafe", "pizza", "kfc",
        "mcdonald", "foodpanda",
    ],
    "Fuel": ["petrol", "fuel", "shell", "pso", "parco", "hascol", "attock", "caltex"],
    "Transport": ["uber", "careem", "indrive", "yango", "bykea", "taxi", "ride"],
    "Utilities": [
        "electricity", "electric", "gas bill", "water bill", "utility", "k-electric", "ssgc",
        "sngpl", "ptcl", "internet",
    ],
    "Healthcare": [
        "hospital", "clinic", "pharmacy", "medical", "medicine", "doctor", "laboratory",
    ],
    "Shopping": ["daraz", "amazon", "shopping", "clothing", "clothes", "mall", "retail", "store"],
    "Income": ["salary", "wages", "payroll", "income"],
    "Transfers": ["transfer", "withdrawal", "atm", "cash withdrawal"],
}

# Terms that make a rule hit questionable (blanks match any whitespace run).
GENERIC_TERMS = [
    "online", "international", "bike", "parking", "car wash", "haircut", "hair cut", "cutting",
    "adjustment", "balance", "misc", "ammi", "ghar", "payment", "cash", "card", "store", "mart",
    "shopping", "ride", "transport", "gas", "oil",
]

# Thresholds.
RULE_METHODS = ("APPROVED_MAPPING", "RULE")
STRONG_PERCENTAGE = 95.0
STRONG_MIN_MAPPED = 5
ML_MIN_CONFIDENCE = 0.80
ML_MIN_MARGIN = 0.20
MAX_SANE_CATEGORY_ID = 10_000
MAX_PER_CLASS = 2000
CONFIDENCE_GRID = [0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95]
MARGIN_GRID = [0.00, 0.05, 0.10, 0.15, 0.20, 0.25]
REPORT_THRESHOLDS = [0.50, 0.60, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95]

# Human-approved (description, type, family, id), in file order.
APPROVED_MAPPINGS = [
    ("cash", "Transfer", "Transfers", 2007),
    ("transfer", "Transfer", "Transfers", 2007),
    ("cash withdrawal", "Transfer", "Transfers", 2007),
    ("transfer for account deletion", "Transfer", "Transfers", 2007),
    ("atm", "Transfer", "Transfers", 2007),
    ("atm withdrawal", "Transfer", "Transfers", 2007),
    ("withdrawal", "Transfer", "Transfers", 2007),
    ("withdrawl", "Transfer", "Transfers", 2007),
    ("cash withdrawl", "Transfer", "Transfers", 2007),
    ("raj grocery", "Expense", "Groceries", 2009),
    ("food", "Transfer", "Dining", 2001),
    ("gj cash from haris", "Transfer", "Transfers", 2007),
    ("dinner at office", "Expense", "Dining", 2001),
    ("prem vegetables", "Expense", "Groceries", 2009),
    ("cash withdraw", "Transfer", "Transfers", 2007),
    ("interest earned", "Income", "Income", 2008),
    ("atm draw", "Transfer", "Transfers", 2007),
    ("atm withdrawl", "Transfer", "Transfers", 2007),
    ("cash atm", "Transfer", "Transfers", 2007),
    ("atm withdraw", "Transfer", "Transfers", 2007),
    ("lunch", "Transfer", "Dining", 2001),
    ("petrol for scooty", "Expense", "Fuel", 2002),
    ("petrol", "Transfer", "Fuel", 2002),
    ("milk", "Transfer", "Groceries", 2009),
    ("petty cash", "Transfer", "Transfers", 2007),
    ("office bike parking", "Expense", "Transport", 2003),
    ("bread", "Transfer", "Groceries", 2009),
    ("buy milk", "Expense", "Groceries", 2009),
    ("uber home ho", "Expense", "Transport", 2003),
    ("diesel", "Transfer", "Fuel", 2002),
    ("atm cash withdrawal", "Transfer", "Transfers", 2007),
    ("internal transfer", "Transfer", "Transfers", 2007),
    ("bike fuel monthly", "Expense", "Fuel", 2002),
    ("cash transfer", "Transfer", "Transfers", 2007),
    ("electricity bill", "Transfer", "Utilities", 2004),
    ("dinner", "Transfer", "Dining", 2001),
    ("transfer to cash", "Transfer", "Transfers", 2007),
    ("careem home office", "Expense", "Transport", 2003),
    ("water bill", "Transfer", "Utilities", 2004),
    ("lunch at ofc", "Expense", "Dining", 2001),
    ("lauka", "Expense", "Groceries", 2009),
    ("milk and chas", "Expense", "Groceries", 2009),
    ("dinner for both", "Expense", "Dining", 2001),
    ("roti", "Transfer", "Dining", 2001),
    ("cat milk", "Expense", "Groceries", 2009),
    ("fruit refund", "Transfer", "Groceries", 2009),
    ("amm atm", "Transfer", "Transfers", 2007),
    ("balance transfer", "Transfer", "Transfers", 2007),
    ("bank transfer", "Transfer", "Transfers", 2007),
    ("cash deposit", "Transfer", "Transfers", 2007),
    ("cash needed", "Transfer", "Transfers", 2007),
    ("transfer new account hysab kytab", "Transfer", "Transfers", 2007),
    ("wallet cash", "Transfer", "Transfers", 2007),
    ("online deposit", "Income", "Income", 2008),
    ("local eggs", "Expense", "Groceries", 2009),
    ("kfc foodpanda", "Expense", "Dining", 2001),
    ("pizza", "Transfer", "Dining", 2001),
    ("benzine", "Expense", "Fuel", 2002),
    ("buy medicine", "Expense", "Healthcare", 2005),
    ("for taxi", "Transfer", "Transport", 2003),
    ("uber ho home", "Expense", "Transport", 2003),
    ("gas bill", "Transfer", "Utilities", 2004),
    ("alam for food", "Expense", "Dining", 2001),
    ("pizza dhoodh gas", "Transfer", "Dining", 2001),
    ("pizza plus khana", "Transfer", "Dining", 2001),
    ("fuel cg", "Expense", "Fuel", 2002),
    ("fruits", "Transfer", "Groceries", 2009),
    ("atm transfer", "Transfer", "Transfers", 2007),
    ("cash deposits", "Transfer", "Transfers", 2007),
    ("funds transfer", "Transfer", "Transfers", 2007),
    ("online transfer", "Transfer", "Transfers", 2007),
    ("transfer to esewa", "Transfer", "Transfers", 2007),
    ("lyari toll", "Expense", "Transport", 2003),
    ("parking", "Transfer", "Transport", 2003),
    ("toll and parking", "Expense", "Transport", 2003),
    ("ptcl bill", "Transfer", "Utilities", 2004),
    ("fuel refill", "Expense", "Fuel", 2002),
    ("milk and eggs", "Expense", "Groceries", 2009),
    ("for mcdonald s", "Transfer", "Dining", 2001),
    ("mira fuel", "Expense", "Fuel", 2002),
    ("petrol thru card", "Expense", "Fuel", 2002),
    ("doodh rotian", "Transfer", "Groceries", 2009),
    ("rotian bread", "Transfer", "Groceries", 2009),
    ("careem earning corolla", "Income", "Transport", 2003),
    ("rickshaw to shuttl stand", "Expense", "Transport", 2003),
    ("bajra", "Expense", "Groceries", 2009),
    ("coles grocery", "Expense", "Groceries", 2009),
    ("milk bottle", "Expense", "Groceries", 2009),
    ("chq deposit", "Income", "Income", 2008),
    ("breakfast", "Transfer", "Dining", 2001),
    ("kfc", "Transfer", "Dining", 2001),
    ("pizza tea", "Transfer", "Dining", 2001),
    ("bick petrol", "Expense", "Fuel", 2002),
    ("petrol corolla", "Expense", "Fuel", 2002),
    ("doodh dahi", "Expense", "Groceries", 2009),
    ("milk clear", "Transfer", "Groceries", 2009),
    ("medicines", "Transfer", "Healthcare", 2005),
    ("mfs salary", "Income", "Income", 2008),
    ("adeel bhai cash deposit from abbottabad for saman", "Transfer", "Transfers", 2007),
    ("atm cash", "Transfer", "Transfers", 2007),
    ("atm cash withdrawal bahl", "Transfer", "Transfers", 2007),
    ("atm transaction", "Transfer", "Transfers", 2007),
    ("atm transferred", "Transfer", "Transfers", 2007),
    ("cash back mariam", "Transfer", "Transfers", 2007),
    ("cash withdrawals for exp", "Transfer", "Transfers", 2007),
    ("cash withdrawn", "Transfer", "Transfers", 2007),
    ("jazz cash", "Transfer", "Transfers", 2007),
    ("khud cash diya", "Transfer", "Transfers", 2007),
    ("numair bhai payment to fahad saleem for spare parts for mezan bank and cash", "Transfer", "Transfers", 2007),
    ("tahir transfer to waris enterprises saleem bhai", "Transfer", "Transfers", 2007),
    ("transfer for saving", "Transfer", "Transfers", 2007),
    ("umair cash withdrawal", "Transfer", "Transfers", 2007),
    ("wechat transfer", "Transfer", "Transfers", 2007),
    ("withdrawal dated 7", "Transfer", "Transfers", 2007),
    ("brown bread", "Expense", "Groceries", 2009),
    ("baby medicine", "Expense", "Healthcare", 2005),
    ("pizza express", "Expense", "Dining", 2001),
    ("roti in office", "Expense", "Dining", 2001),
    ("alto fuel", "Expense", "Fuel", 2002),
    ("bike s petrol", "Expense", "Fuel", 2002),
    ("petrol 2 65ltr", "Expense", "Fuel", 2002),
    ("imraan bread", "Expense", "Groceries", 2009),
    ("milk yugart", "Expense", "Groceries", 2009),
    ("medicine", "Transfer", "Healthcare", 2005),
    ("moona medicine", "Expense", "Healthcare", 2005),
    ("mother medicine", "Expense", "Healthcare", 2005),
    ("patanjali medicine", "Expense", "Healthcare", 2005),
    ("shoes", "Transfer", "Shopping", 2006),
    ("arsalan petty cash", "Transfer", "Transfers", 2007),
    ("cash paid", "Transfer", "Transfers", 2007),
    ("cash received", "Transfer", "Transfers", 2007),
    ("received via atm", "Transfer", "Transfers", 2007),
    ("taxi to work", "Expense", "Transport", 2003),
    ("uber", "Income", "Transport", 2003),
    ("city fuel", "Expense", "Fuel", 2002),
    ("civic petrol", "Expense", "Fuel", 2002),
    ("fruit vegetables", "Expense", "Groceries", 2009),
    ("milk n bread", "Expense", "Groceries", 2009),
    ("ring road toll", "Expense", "Transport", 2003),
]

# Approved (description, source id, canonical id, name).
CATEGORY_MAPPINGS = [
    ("petrol", 5, 2002, "Fuel"),
    ("petrol", 12, 2002, "Fuel"),
    ("petrol", 14, 2002, "Fuel"),
    ("petrol", 33, 2002, "Fuel"),
    ("petrol", 600, 2002, "Fuel"),
    ("petrol", 602, 2002, "Fuel"),
    ("fuel", 14, 2002, "Fuel"),
    ("fuel", 602, 2002, "Fuel"),
    ("bike fuel", 14, 2002, "Fuel"),
    ("bike petrol", 14, 2002, "Fuel"),
    ("car fuel", 14, 2002, "Fuel"),
    ("car petrol", 14, 2002, "Fuel"),
    ("mira fuel", 602, 2002, "Fuel"),
    ("atm", 1, 2007, "Transfers & Withdrawals"),
    ("atm", 4, 2007, "Transfers & Withdrawals"),
    ("atm", 7, 2007, "Transfers & Withdrawals"),
    ("atm", 27, 2007, "Transfers & Withdrawals"),
    ("atm", 29, 2007, "Transfers & Withdrawals"),
    ("atm", 55, 2007, "Transfers & Withdrawals"),
    ("atm", 500, 2007, "Transfers & Withdrawals"),
    ("atm", 515, 2007, "Transfers & Withdrawals"),
    ("atm", 607, 2007, "Transfers & Withdrawals"),
    ("cash", 2, 2007, "Transfers & Withdrawals"),
    ("cash", 12, 2007, "Transfers & Withdrawals"),
    ("cash", 19, 2007, "Transfers & Withdrawals"),
    ("cash", 20, 2007, "Transfers & Withdrawals"),
    ("cash", 21, 2007, "Transfers & Withdrawals"),
    ("cash", 23, 2007, "Transfers & Withdrawals"),
    ("cash", 31, 2007, "Transfers & Withdrawals"),
    ("cash", 42, 2007, "Transfers & Withdrawals"),
    ("cash", 57, 2007, "Transfers & Withdrawals"),
    ("cash", 64, 2007, "Transfers & Withdrawals"),
    ("cash", 110, 2007, "Transfers & Withdrawals"),
    ("cash", 501, 2007, "Transfers & Withdrawals"),
    ("cash", 600, 2007, "Transfers & Withdrawals"),
    ("cash", 625, 2007, "Transfers & Withdrawals"),
    ("cash withdrawal", 8, 2007, "Transfers & Withdrawals"),
    ("cash withdrawal", 514, 2007, "Transfers & Withdrawals"),
    ("cash withdrawal", 625, 2007, "Transfers & Withdrawals"),
    ("cash withdrawal", 629, 2007, "Transfers & Withdrawals"),
    ("online", 52, 2007, "Transfers & Withdrawals"),
    ("online", 501, 2007, "Transfers & Withdrawals"),
    ("online", 514, 2007, "Transfers & Withdrawals"),
    ("online", 626, 2007, "Transfers & Withdrawals"),
    ("online deposit", 514, 2008, "Income"),
    ("cng", 14, 2002, "Fuel"),
    ("cng", 602, 2002, "Fuel"),
    ("cng", 98, 2002, "Fuel"),
    ("cng", 34, 2002, "Fuel"),
    ("cng", 22, 2002, "Fuel"),
    ("cng", 12, 2002, "Fuel"),
    ("cng", 18, 2002, "Fuel"),
    ("cng", 48, 2002, "Fuel"),
    ("cng", 55, 2002, "Fuel"),
    ("cng", 600, 2002, "Fuel"),
    ("transfer", 4, 2007, "Transfers & Withdrawals"),
    ("transfer", 7, 2007, "Transfers & Withdrawals"),
    ("transfer", 27, 2007, "Transfers & Withdrawals"),
    ("transfer", 501, 2007, "Transfers & Withdrawals"),
    ("withdrawal", 12, 2007, "Transfers & Withdrawals"),
    ("withdrawal", 30, 2007, "Transfers & Withdrawals"),
    ("withdrawal", 600, 2007, "Transfers & Withdrawals"),
    ("withdrawl", 625, 2007, "Transfers & Withdrawals"),
    ("withdrawl", 638, 2007, "Transfers & Withdrawals"),
]

# Approved contextual rules (description, type, canonical id, rule).
CONTEXTUAL_RULES = [
    ("cash", "Transfer", 2007, "cash transfer"),
    ("atm", "Transfer", 2007, "atm transfer"),
    ("transfer", "Transfer", 2007, "transfer transfer"),
    ("cng", "Expense", 2002, "cng expense"),
    ("online deposit", "Income", 2008, "online deposit income"),
]


def crosswalk(spark: SparkSession) -> DataFrame:
    """``(v1_id, v2_id)`` for moving old approved ids to the current taxonomy."""
    return spark.createDataFrame(list(CROSSWALK_V1_V2.items()), "v1_id int, v2_id int")


def seed_terms(spark: SparkSession) -> DataFrame:
    """``(canonical_id, family, term, ord)`` of the v1 taxonomy."""
    rows = [
        (cid, TAXONOMY_V1[cid], term, i)
        for cid, terms in SEED_TERMS_V1.items()
        for i, term in enumerate(terms)
    ]
    return spark.createDataFrame(rows, "canonical_id int, family string, term string, ord int")


def category_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        CATEGORY_SEED, "canonical_id int, category_name string, description string"
    )


def approved_mappings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        APPROVED_MAPPINGS,
        "description string, vch_type string, canonical_family string, canonical_id int",
    )


def category_mappings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(*row, True) for row in CATEGORY_MAPPINGS],
        "normalized_description string, source_category_id long,"
        " canonical_category_id int, canonical_name string, approved boolean",
    )


def contextual_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(*row, True) for row in CONTEXTUAL_RULES],
        "normalized_description string, vch_type string, canonical_category_id int,"
        " rule_name string, approved boolean",
    )
