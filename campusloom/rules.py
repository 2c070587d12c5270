"""Word lists, lookup tables, weights, limits and patterns.

Everything in this module is a constant that results depend on; no logic here.
"""

# --- fixed values: text ---------------------------------------------------

ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿšžćčđłńśźżőűğışęąůřťďľĺŕāēīūō"
UNACCENTED = "aaaaaaceeeeiiiinoooooouuuuyyszccdlnszzougiseaurtdllraeiuo"
SLUG_WORDS = {"&": "and", "$": "dollar", "%": "percent", "<": "less", ">": "greater", "|": "or", "ß": "ss", "æ": "ae", "œ": "oe"}

NAME_PUNCTUATION = r"['\"‘’“”.,\-–—/&|]"
SCRIPT_HAN = r"[\x{4e00}-\x{9fff}]"
SCRIPT_ARABIC = r"[\x{0600}-\x{06ff}]"
SCRIPT_CYRILLIC = r"[\x{0400}-\x{04ff}]"

COUNTRY_ALIASES = {
    "usa": "United States",
    "u.s.a.": "United States",
    "u.s.": "United States",
    "us": "United States",
    "united states of america": "United States",
    "uk": "United Kingdom",
    "u.k.": "United Kingdom",
    "great britain": "United Kingdom",
    "england": "United Kingdom",
    "uae": "United Arab Emirates",
    "south korea": "South Korea",
    "republic of korea": "South Korea",
    "russia": "Russia",
    "russian federation": "Russia",
    "china": "China",
    "people's republic of china": "China",
    "czechia": "Czech Republic",
    "czech rep": "Czech Republic",
}

TLD_COUNTRIES = {
    "edu": "United States", "gr": "Greece", "uk": "United Kingdom", "in": "India",
    "au": "Australia", "ca": "Canada", "de": "Germany", "fr": "France", "it": "Italy",
    "es": "Spain", "nl": "Netherlands", "pt": "Portugal", "br": "Brazil", "mx": "Mexico",
    "jp": "Japan", "cn": "China", "kr": "South Korea", "sg": "Singapore",
    "nz": "New Zealand", "za": "South Africa", "ng": "Nigeria", "pk": "Pakistan",
    "bd": "Bangladesh", "lk": "Sri Lanka", "mm": "Myanmar", "th": "Thailand",
    "vn": "Vietnam", "ph": "Philippines", "id": "Indonesia", "my": "Malaysia",
    "tr": "Turkey", "ru": "Russia", "pl": "Poland", "cz": "Czech Republic",
    "ro": "Romania", "bg": "Bulgaria", "hu": "Hungary", "ua": "Ukraine", "se": "Sweden",
    "no": "Norway", "dk": "Denmark", "fi": "Finland", "be": "Belgium",
    "ch": "Switzerland", "at": "Austria", "ie": "Ireland",
}

MONTHS = {
    "jan": "January", "feb": "February", "mar": "March", "apr": "April", "may": "May",
    "jun": "June", "jul": "July", "aug": "August", "sep": "September", "sept": "September",
    "oct": "October", "nov": "November", "dec": "December",
}

PROGRAM_LEVELS = ["Undergraduate", "Postgraduate", "PhD", "Diploma", "Certificate"]
COURSE_LEVELS = {
    "Undergraduate": "Bachelor",
    "Postgraduate": "Master",
    "Doctorate": "PhD",
    "PhD": "PhD",
    "Diploma": "Diploma",
    "Certificate": "Diploma",
}
NON_SUBJECTS = ["full-time", "part-time", "online", "distance", "blended", "hybrid", "n/a", "other", "various"]

BOILERPLATE_STARTS = [
    "home", "menu", "skip to", "back to top", "share", "follow us", "copyright",
    "all rights reserved", "privacy policy", "terms of use", "sitemap",
]
BOILERPLATE_SITES = ["facebook", "twitter", "linkedin", "instagram", "youtube", "social media"]
SEPARATOR_LINE = r"^\s*[|•·–—]\s*$"
NAVIGATION_OPENINGS = ["learn more", "click here", "home", "menu", "contact us", "toggle", "cookie", "accept"]
DEAD_REASON = r"(?i)Domain dead|ENOTFOUND"

# --- fixed values: url scores ---------------------------------------------

TRACKING_PARAMETERS = ["utm_source", "utm_medium", "utm_campaign", "ref", "source"]

# Additive: every matching pattern counts; -999 excludes the page.
LINK_SCORES = [
    (r"admiss", 100),
    (r"apply|application", 95),
    (r"tuition|fee|fees|financ|cost", 90),
    (r"program|programme", 85),
    (r"course|courses|curriculum", 80),
    (r"academic|academics", 75),
    (r"undergraduate|ug\b", 75),
    (r"postgraduate|pg\b|graduate|master", 70),
    (r"phd|doctoral|doctorate", 70),
    (r"international|global", 65),
    (r"scholarship", 60),
    (r"requirement|eligib", 60),
    (r"btech|mtech|mba|msc|bsc", 65),
    (r"about|overview", 40),
    (r"department|school|faculty", 35),
    (r"campus|gallery", 20),
    (r"news|event|blog|article|press|award|conference", -999),
    (r"calendar|sports|ceremony|archive", -999),
    (r"staff|directory|trustee|personnel", -999),
    (r"login|register|signup|cart|payment|checkout", -999),
    (r"\.(pdf|doc|docx|xls|xlsx|ppt|pptx|zip|rar)$", -999),
    (r"wp-admin|wp-login|wp-json", -999),
    (r"tag/", -999),
    (r"category/", -999),
    (r"\?p=[0-9]+", -999),
    (r"\?page_id=[0-9]+", -999),
]

# First match wins; 5 when nothing matches.
SITEMAP_SCORES = [
    (r"/admiss", 100),
    (r"/apply|/application", 95),
    (r"/tuition|/fee|/financ|/cost", 90),
    (r"/program|/programme", 85),
    (r"/course|/curriculum", 80),
    (r"/academic", 75),
    (r"/undergraduate|/ug\b", 75),
    (r"/postgraduate|/graduate|/master", 70),
    (r"/phd|/doctoral", 70),
    (r"/international", 65),
    (r"/scholarship", 60),
    (r"/about|/overview", 40),
    (r"/news|/event|/blog|/article|/press", -999),
    (r"/staff|/directory|/trustee", -999),
    (r"/login|/register|/cart", -999),
    (r"\.(pdf|doc|zip)$", -999),
    (r"/tag/|/category/", -999),
    (r"\?p=[0-9]+|\?page_id=[0-9]+", -999),
]
SITEMAP_NEUTRAL = 5
SITEMAP_RELEVANT = r"(?i)admiss|program|course|academic"

# First match wins; 10 when nothing matches.
CRAWL_SCORES = [
    (r"admission", 100),
    (r"apply", 95),
    (r"tuition|fee", 90),
    (r"program", 85),
    (r"course|curriculum", 80),
    (r"academic", 75),
    (r"undergraduate|btech", 70),
    (r"postgraduate|master|mtech", 65),
    (r"phd|doctoral", 65),
    (r"international", 55),
    (r"scholarship|requirement", 50),
    (r"about|overview", 35),
    (r"news|event|blog", -99),
    (r"staff|directory", -99),
]
CRAWL_NEUTRAL = 10

# Additive section scores; all patterns ignore case.
SECTION_SCORES = [
    (r"admiss|apply|application", 60),
    (r"tuition|fee|fees|cost|scholarship", 50),
    (r"program|programme|course|curriculum|degree", 40),
    (r"ielts|toefl|gpa|gre|gmat|requirement|eligib", 40),
    (r"undergraduate|postgraduate|phd|master|bachelor", 30),
    (r"about|overview|founded|established|history|mission", 25),
    (r"department|faculty|school of|college of", 20),
    (r"international|global|exchange", 15),
    (r"research|publication|ranking", 10),
    (r"news|event|blog|award|ceremony|announcement", -40),
    (r"login|register|cart|checkout|privacy|cookie", -50),
]
SECTION_MARK = r"\[(?:PAGE|SECTION|EXTERNAL[^\]]*)\s*\d*\]"
PRIORITY_TEXT = r"(?i)admiss|tuition|fee|program|course"

# --- fixed values: images -------------------------------------------------

IMAGE_SKIP = [
    "favicon", "icon-", "-icon", "arrow", "button", "social", "twitter", "facebook",
    "linkedin", "instagram", "youtube", "sprite", "avatar", "thumbnail", "logo-white",
    "logo-dark", "placeholder", "blank", "loading", "spinner", "menu", "hamburger",
]
IMAGE_TYPES = {
    "logo": ["logo", "brand", "icon", "emblem", "seal", "crest", "badge", "shield"],
    "campus": ["campus", "aerial", "overview", "panorama", "quad", "courtyard", "main", "ground"],
    "classroom": ["classroom", "lecture", "lab", "laboratory", "study", "library", "seminar", "workshop"],
    "building": ["building", "hall", "tower", "faculty", "block", "center", "centre", "architecture"],
}
IMAGE_MIN_BYTES = 5000
LOGO_CANDIDATES = 5
PHOTO_CANDIDATES = 8

# --- fixed values: page elements dropped before reading the text ----------

NOISE_TAGS = ["nav", "header", "footer", "aside", "script", "style", "noscript", "iframe", "object", "embed"]
NOISE_CLASS_PARTS = ["cookie", "gdpr", "consent", "advertisement", "popup", "modal", "overlay", "dialog", "chatbot", "chat-widget"]
NOISE_ID_PARTS = ["cookie", "gdpr", "consent", "advertisement", "popup", "modal", "chat"]
NOISE_CLASSES = [
    "ads", "ad-wrapper", "ad-container", "intercom-container", "sidebar", "side-bar",
    "social-share", "social-links", "breadcrumb", "breadcrumbs", "pagination",
    "newsletter", "subscribe", "wp-block-shortcode", "elementor-location-header",
    "elementor-location-footer", "crisp-client",
]
NOISE_IDS = ["intercom-container", "crisp-chatbox", "sidebar"]
NAV_CLASSES = {"menu", "navigation"}

# --- fixed values: entities in attribute values, the ampersand last --------

ENTITIES = {
    "&quot;": '"', "&#34;": '"', "&#39;": "'", "&apos;": "'", "&lt;": "<", "&gt;": ">",
    "&#x2F;": "/", "&#47;": "/", "&#38;": "&", "&#x26;": "&", "&amp;": "&",
}

# --- fixed values: search-result titles -----------------------------------

TITLE_LIMIT = 60
DESCRIPTION_LIMIT = 155
TRUNCATE_TOLERANCE = 0.25
META_THRESHOLD = 3

# --- fixed values: text search weights and stop words ---------------------

COURSE_WEIGHTS = {"title": 10, "field": 6, "subtitle": 4, "popular_job_roles": 3, "overview_description": 2}
UNIVERSITY_WEIGHTS = {"name": 10, "city": 4, "description": 2}
COUNTRY_WEIGHTS = {"name": 10, "continent": 5, "capital": 4, "popular_courses": 6}
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "the", "to", "with"]
MATCH_FLOOR = 1.0

# --- fixed values: record quality -----------------------------------------

CONFIDENCE_PARTIAL = 0.62
CONFIDENCE_TRUSTED = 0.8
SKIP_MODEL_AT = 0.82
ENRICHED_AT = 0.55
COMPLETED_AT = 0.72
TERMINAL_ATTEMPTS = 99

# --- fixed values: gap filling --------------------------------------------

ENGLISH_COUNTRIES = ["United States", "United Kingdom", "Australia", "Canada", "New Zealand", "Ireland"]

TUITION_BY_COUNTRY = {
    "United States": "USD 15,000–35,000/year (estimated)",
    "United Kingdom": "GBP 10,000–26,000/year (estimated)",
    "Australia": "AUD 20,000–45,000/year (estimated)",
    "Canada": "CAD 15,000–35,000/year (estimated)",
    "India": "INR 50,000–400,000/year (estimated)",
    "Germany": "EUR 0–500/semester (estimated)",
    "France": "EUR 200–700/year (estimated)",
    "Netherlands": "EUR 2,000–18,000/year (estimated)",
    "Ireland": "EUR 9,000–25,000/year (estimated)",
    "Singapore": "SGD 20,000–40,000/year (estimated)",
    "New Zealand": "NZD 22,000–45,000/year (estimated)",
    "South Africa": "ZAR 30,000–80,000/year (estimated)",
    "Nigeria": "NGN 50,000–500,000/year (estimated)",
    "Pakistan": "PKR 100,000–500,000/year (estimated)",
    "Bangladesh": "BDT 50,000–200,000/year (estimated)",
    "Myanmar": "USD 500–3,000/year (estimated)",
    "Bulgaria": "EUR 2,000–8,000/year (estimated)",
    "Romania": "EUR 2,000–6,000/year (estimated)",
    "Poland": "EUR 2,000–6,000/year (estimated)",
    "Czech Republic": "EUR 2,000–8,000/year (estimated)",
    "Hungary": "EUR 1,500–5,000/year (estimated)",
    "Brazil": "BRL 10,000–40,000/year (estimated)",
    "Turkey": "USD 3,000–10,000/year (estimated)",
    "Malaysia": "MYR 10,000–30,000/year (estimated)",
    "China": "CNY 20,000–50,000/year (estimated)",
    "Japan": "JPY 500,000–1,500,000/year (estimated)",
    "South Korea": "KRW 4,000,000–8,000,000/year (estimated)",
    "Vietnam": "USD 1,500–5,000/year (estimated)",
    "Philippines": "PHP 50,000–200,000/year (estimated)",
    "Indonesia": "IDR 10,000,000–50,000,000/year (estimated)",
    "Thailand": "THB 50,000–200,000/year (estimated)",
    "Egypt": "USD 2,000–6,000/year (estimated)",
    "Kenya": "KES 50,000–300,000/year (estimated)",
    "Ghana": "USD 1,500–5,000/year (estimated)",
    "Sri Lanka": "LKR 100,000–500,000/year (estimated)",
    "Nepal": "NPR 100,000–400,000/year (estimated)",
    "Ukraine": "USD 2,000–5,000/year (estimated)",
    "Russia": "USD 2,000–8,000/year (estimated)",
    "Sweden": "SEK 80,000–180,000/year (estimated)",
    "Norway": "NOK 0–50,000/year (estimated)",
    "Denmark": "DKK 0–50,000/year (estimated)",
    "Finland": "EUR 0–18,000/year (estimated)",
    "Belgium": "EUR 835–4,000/year (estimated)",
    "Switzerland": "CHF 1,000–30,000/year (estimated)",
    "Austria": "EUR 726–15,000/year (estimated)",
    "Spain": "EUR 1,000–10,000/year (estimated)",
    "Italy": "EUR 1,000–10,000/year (estimated)",
    "Portugal": "EUR 1,000–8,000/year (estimated)",
    "Greece": "EUR 1,500–6,000/year (estimated)",
    "Mexico": "MXN 30,000–150,000/year (estimated)",
}
TUITION_DEFAULT = "Contact university for fee details (estimated)"

INTAKES_BY_COUNTRY = {
    "United States": ["Fall", "Spring"],
    "Canada": ["Fall", "Winter"],
    "United Kingdom": ["September", "January"],
    "Australia": ["February", "July"],
    "New Zealand": ["February", "July"],
    "India": ["July", "January"],
    "Germany": ["October", "April"],
    "France": ["September", "January"],
    "Netherlands": ["September", "February"],
    "Ireland": ["September", "January"],
    "Japan": ["April", "October"],
    "China": ["September", "February"],
    "South Korea": ["March", "September"],
    "Singapore": ["August", "January"],
    "Malaysia": ["March", "September"],
    "Bulgaria": ["September", "February"],
    "Brazil": ["March", "August"],
    "Turkey": ["September", "February"],
    "Russia": ["September", "February"],
    "Myanmar": ["December", "June"],
}
INTAKES_DEFAULT = ["September", "January"]
# The lighter fill right after an extraction knows only these countries.
EXTRACTION_INTAKES = {
    "United States": ["Fall", "Spring"],
    "Canada": ["Fall", "Winter"],
    "United Kingdom": ["September", "January"],
    "Australia": ["February", "July"],
    "India": ["July", "January"],
    "Brazil": ["March", "August"],
    "Bulgaria": ["September", "February"],
    "Myanmar": ["December", "June"],
}

SIMILAR_BY_COUNTRY = {
    "United States": ["University of Michigan", "Arizona State University", "University of Florida"],
    "United Kingdom": ["University of Hertfordshire", "Coventry University", "Middlesex University London"],
    "Australia": ["RMIT University", "Curtin University", "Western Sydney University"],
    "Canada": ["University of Calgary", "Carleton University", "University of Manitoba"],
    "India": ["Manipal University", "SRM Institute", "Lovely Professional University"],
    "Germany": ["Hochschule München", "Fachhochschule Dortmund", "Hochschule Düsseldorf"],
    "France": ["Université Paris-Saclay", "Sorbonne University", "University of Lyon"],
    "Netherlands": ["University of Groningen", "Leiden University", "Radboud University"],
    "Ireland": ["University College Dublin", "Dublin City University", "University of Limerick"],
    "Singapore": ["Nanyang Technological University", "Singapore Management University", "SIM University"],
    "Bulgaria": ["Sofia University", "Technical University of Sofia", "University of Plovdiv"],
    "Pakistan": ["University of Karachi", "COMSATS University", "Lahore University of Management Sciences"],
    "Nigeria": ["University of Lagos", "Obafemi Awolowo University", "University of Ibadan"],
    "Bangladesh": ["University of Dhaka", "BRAC University", "North South University"],
    "Myanmar": ["University of Yangon", "Mandalay University", "University of Medicine Mandalay"],
    "Malaysia": ["Universiti Malaya", "Universiti Teknologi Malaysia", "Universiti Putra Malaysia"],
    "China": ["Fudan University", "Wuhan University", "Sun Yat-sen University"],
    "Brazil": ["University of São Paulo", "UNICAMP", "Federal University of Rio de Janeiro"],
}
SIMILAR_DEFAULT = ["A leading national university", "A regional research university", "An established local university"]

STUDENTS_BY_TYPE = {
    "university": "8,000–20,000 (estimated)",
    "technical": "5,000–15,000 (estimated)",
    "college": "2,000–8,000 (estimated)",
    "community": "1,000–5,000 (estimated)",
    "specialized": "500–3,000 (estimated)",
}

PROGRAMS_BY_TYPE = {
    "university": [
        ("Business Administration", "Undergraduate"),
        ("Computer Science", "Undergraduate"),
        ("Engineering", "Undergraduate"),
        ("Business Administration", "Postgraduate"),
        ("Computer Science", "Postgraduate"),
    ],
    "technical": [
        ("Computer Science", "Undergraduate"),
        ("Mechanical Engineering", "Undergraduate"),
        ("Civil Engineering", "Undergraduate"),
        ("Electrical Engineering", "Postgraduate"),
        ("Information Technology", "Postgraduate"),
    ],
    "college": [
        ("Business Studies", "Undergraduate"),
        ("Information Technology", "Undergraduate"),
        ("Health Sciences", "Undergraduate"),
    ],
    "community": [
        ("Business Studies", "Diploma"),
        ("Information Technology", "Certificate"),
        ("Healthcare", "Diploma"),
    ],
    "specialized": [
        ("Fine Arts", "Undergraduate"),
        ("Design", "Undergraduate"),
        ("Media Studies", "Postgraduate"),
    ],
}

REQUIREMENTS_ENGLISH = [
    "Completed online application form with supporting documents",
    "Official academic transcripts from all previous institutions",
    "English language proficiency test (IELTS 6.0 or TOEFL 80 minimum)",
    "Two letters of recommendation from academic or professional referees",
    "Personal statement outlining academic goals and motivations",
]
REQUIREMENTS_OTHER = [
    "Completed application form with required documents",
    "Official academic transcripts and certified translations",
    "English language proficiency test results (IELTS 6.0 or TOEFL 80)",
    "Passport copy or national identity document",
    "Statement of purpose and academic references",
]
EXTRACTION_REQUIREMENTS_ENGLISH = [
    "Completed online application form",
    "Official academic transcripts from all previous institutions",
    "Proof of English language proficiency (IELTS/TOEFL)",
    "Two letters of recommendation",
    "Personal statement or statement of purpose",
]
EXTRACTION_REQUIREMENTS_OTHER = [
    "Completed application form with required documents",
    "Official academic transcripts and certificates",
    "English language proficiency test results (IELTS 6.0 or TOEFL 80)",
    "Passport copy or national ID",
    "Statement of purpose",
]
