"""The words, domains and bounds that results must carry exactly."""

# Cell texts that a CSV source reads as null.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Right-closed price bands: (0, 50], (50, 200], (200, 500], (500, inf].
PRICE_TIER_EDGES = (0, 50, 200, 500, float("inf"))
PRICE_TIERS = ("Budget", "Standard", "Premium", "Luxury")

# Right-closed amount bands: (0, 100], (100, 500], (500, 1000], (1000, inf].
REVENUE_EDGES = (0, 100, 500, 1000, float("inf"))
REVENUE_CATEGORIES = ("Small", "Medium", "Large", "Enterprise")

# E-mail domains by customer segment.
CORPORATE_DOMAINS = ("company.com", "business.com", "corp.com")
PERSONAL_DOMAINS = ("gmail.com", "yahoo.com", "hotmail.com", "outlook.com")

# Fill values for missing text.
NO_CATEGORY = "UNCATEGORIZED"
NO_REGION = "UNKNOWN"
