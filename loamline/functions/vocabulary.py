"""Word lists and patterns of the collection's taxonomy, stated plainly."""

from __future__ import annotations

# Subject domains of news and reports, in their order of precedence.
DOMAIN_KEYWORDS = {
    "agriculture": ["agriculture", "agricultural", "agribusiness", "farming", "farm", "farmer", "crop", "livestock", "smallholder", "agronomy", "food security"],
    "Agricultural Economics": ["farm income", "agricultural income", "food price", "commodity price", "farm gate", "subsidy", "inflation", "gdp", "rural economy"],
    "Agricultural International Trade (Exports & Imports)": [
        "export", "exports", "import", "imports", "cross-border", "customs", "tariff", "trade agreement", "phytosanitary",
    ],
    "Agricultural Environmental & Climate": ["climate", "rainfall", "drought", "temperature", "extreme weather", "flood", "heatwave", "emissions"],
    "Land Use & Soil Health": ["land use", "soil", "erosion", "fertility", "degradation"],
    "Agricultural Investment Readiness & Enterprise": ["investment", "enterprise", "entrepreneur", "finance", "credit", "loan", "bank", "funding"],
    "Agricultural Technology & Innovation": ["technology", "innovation", "digital", "ai", "satellite", "remote sensing", "irrigation technology"],
    "Agricultural Market Access & Infrastructure": [
        "market access", "logistics", "infrastructure", "transport", "storage", "post-harvest", "warehouse", "cold chain",
    ],
    "Agricultural Production & Yield": ["yield", "production", "productivity", "harvest", "acreage"],
    "Agricultural Policy & Institutional": ["policy", "regulation", "ministry", "institution", "governance", "subsidy"],
    "Agricultural Gender, Youth & Inclusion": ["gender", "women", "youth", "inclusion", "smallholder"],
    "Agricultural Nutrition & Food Security": ["nutrition", "food security", "malnutrition", "hunger", "stunting", "food insecure"],
    "Agricultural Food Systems & Value Chain": ["value chain", "food system", "processing", "distribution", "retail", "supply chain"],
    "Agricultural Humanitarian & Agricultural Emergency": ["humanitarian", "emergency", "crisis", "famine", "displacement", "conflict"],
}
# Countries looked for in texts; two names stand for the same country.
PLACES = [
    "Algeria", "Angola", "Benin", "Botswana", "Burkina Faso", "Burundi", "Cameroon", "Cape Verde", "Central African Republic", "Chad", "Comoros", "Congo", "Djibouti",
    "Egypt", "Equatorial Guinea", "Eritrea", "Eswatini", "Ethiopia", "Gabon", "Gambia", "Ghana", "Guinea", "Guinea-Bissau", "Ivory Coast", "Cote d'Ivoire", "Kenya",
    "Lesotho", "Liberia", "Libya", "Madagascar", "Malawi", "Mali", "Mauritania", "Mauritius", "Morocco", "Mozambique", "Namibia", "Niger", "Nigeria", "Rwanda",
    "Sao Tome and Principe", "Senegal", "Seychelles", "Sierra Leone", "Somalia", "South Africa", "South Sudan", "Sudan", "Tanzania", "Togo", "Tunisia", "Uganda",
    "Zambia", "Zimbabwe", "DRC", "Democratic Republic of the Congo",
]
PLACE_ALIASES = {"DRC": "Democratic Republic of the Congo", "Congo": "Democratic Republic of the Congo"}
# Path parts that are section fronts, not articles.
HUB_SLUGS = [
    "news", "world", "nation", "national", "global", "business", "sports", "entertainment", "lifestyle", "technology", "politics", "local", "metro", "regions", "environment",
    "opinion", "rss", "feed", "feeds", "category", "categories", "tag", "tags", "articles", "latest", "breaking", "home", "index",
]
# Patterns of section roles over heading paths, first match wins.
BOILERPLATE_PATH = (
    r"(journal_homepage|elsevier|springer|wiley|doi_org|https?_|www_|available_online|copyright|all_rights_reserved|open_access|creative_commons|issn|isbn|"
    r"article_history|received_date|land_use_policy_\d|sciencedirect|sci_hub)"
)
TITLE_ROLES = [
    ("acknowledgements", "^acknowledg"), ("acknowledgements", "^remerciements"), ("references", "^references?$"), ("references", "^bibliograph"), ("abstract", "^abstract$"),
    ("appendix", "^append"),
]
PATH_ROLES = [
    ("abstract", "(^|/)(abstract|resume|resumé|summary)(/|$)"),
    ("introduction", "(^|/)(introduction|intro|background|contexte|context)(/|$)"),
    ("methods", "(^|/)(methods|methodology|materials_and_methods|materials|methods_and_materials|methodes|materiel_et_methodes|méthodes)(/|$)"),
    ("results", "(^|/)(results|findings|resultats|résultats)(/|$)"),
    ("discussion", "(^|/)(discussion|interpretation)(/|$)"),
    ("conclusion", "(^|/)(conclusion|conclusions|concluding_remarks)(/|$)"),
    ("acknowledgements", "(^|/)(acknowledgements|acknowledgments|acknowledgement|remerciements|funding|financial_support|grant_support)(/|$)"),
    ("references", "(^|/)(references|bibliography|bibliographie|literature_cited|works_cited|cited_references)(/|$)"),
    ("appendix", "(^|/)(appendix|appendices|supplementary|supplemental|annexe|annexes)(/|$)"),
]
GOVERNMENT_MARKERS = ["national bureau of statistics", "official gazette", "government of", "ministry of", "policy brief"]
EXCLUDED_ROLES = ["acknowledgements", "references", "boilerplate", "appendix"]
# Fixed value: the namespace that chunk identifiers are made in.
CHUNK_NAMESPACE = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
# Words that show an agricultural context.
AGRICULTURE_TERMS = [
    "agriculture", "agricultural", "agribusiness", "agrifood", "agritech", "agrotech", "agro-", "farmer", "farmers", "farming", "farm", "smallholder", "livestock", "cattle", "poultry", "pastoral",
    "ranch", "crop", "crops", "harvest", "planting", "irrigation", "fertilizer", "fertiliser", "pesticide", "seed", "seeds", "soil", "hectare", "hectares", "food security", "malnutrition", "stunting",
    "hunger crisis", "famine", "cassava", "maize", "rice", "wheat", "cocoa", "palm oil", "yam", "millet", "sorghum", "aquaculture", "fisheries", "fishery", "extension service", "extension officer",
    "agric extension", "ministry of agriculture", "minister of agriculture", "agrarian", "farmland", "arable", "post-harvest", "value chain", "commodity", "farm gate", "grain", "silos", "greenhouse",
    "dairy", "milk production", "meat processing", "rural road", "rural market", "farm to market",
]
# Names that stand for another country name in a question; all other places stand for themselves.
QUESTION_ALIASES = {
    "cabo verde": "Cabo Verde", "cape verde": "Cabo Verde", "car": "Central African Republic", "congo": "Republic of the Congo", "congo-brazzaville": "Republic of the Congo",
    "congo republic": "Republic of the Congo", "republic of the congo": "Republic of the Congo", "congo-kinshasa": "Democratic Republic of the Congo", "drc": "Democratic Republic of the Congo",
    "swaziland": "Eswatini", "ivory coast": "Côte d'Ivoire", "côte d'ivoire": "Côte d'Ivoire",
}
# Regions, too broad to filter news by.
REGIONS = [
    "africa", "sub-saharan africa", "sub saharan africa", "east africa", "west africa", "southern africa", "north africa", "central africa", "african continent", "global", "worldwide", "international",
]
# What tells a question's intent, first match wins.
INTENTS = [
    ("predictive", r"likely|forecast|predict|projection|outlook|scenario|what if|expect|\bwill\b"),
    ("monitoring", r"monitor|track|worsening|emerging|watch|ongoing|alert"),
    ("compare", r"compare|versus|(^|\s)vs\s| rank |\b(top|bottom|best|worst|highest|lowest)\b"),
    ("locate", r"where should|which regions|priority areas|focus on|where to|which areas|priority region"),
    ("decision_support", r"should we|what should|recommend|allocate|prioritize|policy design|\binvest(ing|ment)?\b|\bfund(ing)?\b"),
    ("diagnostic", r"why|because|driver|cause|explain|due to|reason"),
]
# Titles that a fetch brings back instead of the page's.
BAD_TITLES = ["google news", "news", "home", "sign in", "before you continue", "", "error 400 (bad request)!!1", "error 400 (bad request)"]
