"""Fixed values that decide results: word lists, rule orders, constants.

Everything in this file is data.  The order of a list is part of its meaning
wherever the docstring or comment says "first match wins".
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Title classes, first match wins, substrings of the lower title.
TITLE_RULES: list[tuple[str, list[str]]] = [
    ("software engineer", ["software engineer", "software developer"]),
    ("data scientist", ["data scientist"]),
    ("data engineer", ["data engineer"]),
    ("data analyst", ["data analyst"]),
    ("machine learning engineer", ["machine learning", "ml engineer"]),
    ("devops engineer", ["devops", "sre"]),
    ("frontend engineer", ["frontend", "front end", "front-end"]),
    ("backend engineer", ["backend", "back end", "back-end"]),
    ("fullstack engineer", ["fullstack", "full stack", "full-stack"]),
    ("product manager", ["product manager"]),
    ("project manager", ["project manager"]),
    ("ux/ui designer", ["ux", "ui", "user experience", "user interface"]),
    ("qa engineer", ["qa", "quality assurance", "test"]),
    ("it support specialist", ["it specialist", "it support"]),
    ("security engineer", ["security", "cybersecurity"]),
    ("network engineer", ["network"]),
    ("system administrator", ["system", "sysadmin"]),
    ("database administrator", ["database", "dba"]),
    ("cloud engineer", ["cloud"]),
    ("ai engineer", ["ai", "artificial intelligence"]),
]
TITLE_OTHER = "other"
TITLE_UNKNOWN = "unknown"

# Location rules.  The pattern is tried first, then the named
# places in order, then the countries in order.
LOCATION_PATTERN = r"([A-Z]{2})|([A-Za-z]+,\s*[A-Z]{2})"
LOCATION_NAMED: list[tuple[str, list[str]]] = [
    ("US", ["United States", "USA", "U.S."]),
    ("UK", ["United Kingdom", "UK", "U.K."]),
    ("Remote", ["Remote"]),
]
COUNTRIES = [
    "Canada", "Germany", "France", "Australia", "India", "Japan", "China",
    "Brazil", "Mexico", "Spain", "Italy", "Netherlands", "Sweden",
    "Switzerland", "Poland", "Ukraine", "Austria", "Belgium", "Denmark",
    "Finland", "Greece", "Hungary", "Ireland", "Norway", "Portugal", "Romania",
]
LOCATION_OTHER = "Other"
LOCATION_UNKNOWN = "Unknown"

# 50 state codes, then US and DC.
US_CODES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
    "US", "DC",
]

# Salary period, first match wins on the lower salary text.
PERIOD_RULES: list[tuple[str, list[str]]] = [
    ("Hourly", ["hourly", "hour"]),
    ("Annually", ["annually", "annual", "year"]),
    ("Monthly", ["month"]),
    ("Daily", ["day"]),
]
PERIOD_UNKNOWN = "Unknown"
PERIOD_FACTOR = {"Hourly": 40 * 52, "Daily": 5 * 52, "Monthly": 12}

# Texts that stand for a missing field.
NOT_SPECIFIED = "Not specified"
NOT_PROVIDED = "Not Provided"
SENTINELS = [NOT_SPECIFIED, NOT_PROVIDED]

# Texts a CSV reader with default settings takes as missing.
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Defaults for missing fields of a posting.
FILL_TITLE = "Unknown Position"
FILL_LOCATION = "Unknown Location"
FILL_COMPANY = "Unknown"
FILL_CATEGORY = "missing"

# Salary text by title, first key contained in the lower title.
SALARY_TEXT_BY_TITLE: list[tuple[str, str]] = [
    ("software engineer", "$90,000 to $130,000 per year"),
    ("senior software engineer", "$120,000 to $160,000 per year"),
    ("data scientist", "$100,000 to $140,000 per year"),
    ("data engineer", "$95,000 to $135,000 per year"),
    ("data analyst", "$70,000 to $100,000 per year"),
    ("machine learning engineer", "$110,000 to $150,000 per year"),
    ("devops engineer", "$100,000 to $140,000 per year"),
    ("frontend engineer", "$85,000 to $125,000 per year"),
    ("backend engineer", "$90,000 to $130,000 per year"),
    ("fullstack engineer", "$95,000 to $135,000 per year"),
    ("product manager", "$110,000 to $150,000 per year"),
    ("project manager", "$90,000 to $130,000 per year"),
    ("ux/ui designer", "$80,000 to $120,000 per year"),
    ("qa engineer", "$70,000 to $110,000 per year"),
    ("it support", "$50,000 to $80,000 per year"),
    ("security engineer", "$100,000 to $140,000 per year"),
    ("network engineer", "$80,000 to $120,000 per year"),
    ("system administrator", "$75,000 to $115,000 per year"),
    ("database administrator", "$85,000 to $125,000 per year"),
    ("cloud engineer", "$100,000 to $140,000 per year"),
    ("ai engineer", "$120,000 to $160,000 per year"),
]
SALARY_TEXT_DEFAULT = "$70,000 to $90,000 per year"

# Mean annual salary by standard title.
MEAN_BY_TITLE: dict[str, int] = {
    "software engineer": 110000,
    "data scientist": 120000,
    "data engineer": 115000,
    "data analyst": 85000,
    "machine learning engineer": 130000,
    "devops engineer": 120000,
    "frontend engineer": 105000,
    "backend engineer": 110000,
    "fullstack engineer": 115000,
    "product manager": 130000,
    "project manager": 110000,
    "ux/ui designer": 100000,
    "qa engineer": 90000,
    "it support specialist": 65000,
    "security engineer": 120000,
    "network engineer": 100000,
    "system administrator": 95000,
    "database administrator": 105000,
    "cloud engineer": 120000,
    "ai engineer": 140000,
    "other": 90000,
}
MEAN_DEFAULT = 90000
MISSING_SHARE_LIMIT = 0.9
JITTER_LOW, JITTER_HIGH = 0.8, 1.2

# The skill vocabulary; results list skills in this order.
SKILLS = [
    "python", "java", "javascript", "js", "html", "css", "sql", "nosql", "mongodb",
    "postgresql", "mysql", "oracle", "aws", "azure", "gcp", "cloud", "docker",
    "kubernetes", "k8s", "git", "ci/cd", "jenkins", "terraform", "ansible", "bash",
    "linux", "windows", "macos", "react", "angular", "vue", "node", "express",
    "django", "flask", "spring", "hibernate", "scala", "rust", "go", "golang",
    "c++", "c#", ".net", "php", "laravel", "swift", "kotlin", "objective-c",
    "tensorflow", "pytorch", "scikit-learn", "pandas", "numpy", "machine learning",
    "deep learning", "nlp", "computer vision", "ai", "data science", "hadoop",
    "spark", "kafka", "elasticsearch", "tableau", "power bi", "excel", "vba",
    "r", "sas", "spss", "matlab", "agile", "scrum", "kanban", "jira", "confluence",
    "rest", "soap", "graphql", "api", "microservices", "devops", "sre", "security",
    "networking", "tcp/ip", "http", "dns", "ssl", "tls", "authentication", "oauth",
    "authorization", "encryption", "firewall", "vpn", "typescript", "redux",
    "webpack", "sass", "less", "bootstrap", "tailwind", "jquery", "web development",
    "mobile development", "ios", "android", "react native", "flutter",
]

# Skills assumed when none is named.  First match wins; a rule
# holds when every group has at least one of its words in the lower text.
FALLBACK_SKILLS: list[tuple[list[list[str]], list[str]]] = [
    ([["software", "developer"]], ["java", "python", "javascript"]),
    ([["data"], ["science"]], ["python", "r", "machine learning", "sql"]),
    ([["data"], ["engineer"]], ["sql", "python", "spark", "aws"]),
    ([["web"]], ["html", "css", "javascript"]),
    ([["devops"]], ["docker", "kubernetes", "aws", "ci/cd"]),
    ([["network"]], ["networking", "tcp/ip", "security"]),
    ([["security"]], ["security", "encryption", "firewall"]),
    ([["support"]], ["windows", "troubleshooting", "networking"]),
]

# Default skills by standard title.
DEFAULT_SKILLS_BY_TITLE: dict[str, list[str]] = {
    "software engineer": ["java", "python", "javascript"],
    "data scientist": ["python", "r", "machine learning", "sql"],
    "data engineer": ["sql", "python", "spark", "aws"],
    "machine learning engineer": ["python", "tensorflow", "pytorch"],
    "devops engineer": ["docker", "kubernetes", "aws", "ci/cd"],
    "frontend engineer": ["javascript", "html", "css", "react"],
    "backend engineer": ["java", "python", "node", "sql"],
    "fullstack engineer": ["javascript", "html", "css", "node", "sql"],
    "qa engineer": ["testing", "selenium", "qa"],
    "it support specialist": ["windows", "troubleshooting", "networking"],
    "security engineer": ["security", "encryption", "firewall"],
    "network engineer": ["networking", "tcp/ip", "cisco"],
    "system administrator": ["linux", "windows", "server"],
    "database administrator": ["sql", "oracle", "mysql", "postgresql"],
    "cloud engineer": ["aws", "azure", "gcp", "terraform"],
}

# What is searched for, by category.
SEARCH_TITLES: dict[str, list[str]] = {
    "Software Engineering & Development": [
        "Software Engineer", "Full-Stack Developer", "Front-End Developer",
        "Back-End Developer", "Web Developer", "Mobile App Developer",
        "Embedded Systems Engineer", "Game Developer", "DevOps Engineer",
        "Firmware Engineer",
    ],
    "Data Science & AI": [
        "Data Scientist", "Machine Learning Engineer", "AI Engineer",
        "Deep Learning Engineer", "NLP Engineer", "Computer Vision Engineer",
        "Data Engineer", "Big Data Engineer", "Business Intelligence Developer",
        "Quantitative Analyst",
    ],
    "Cybersecurity & IT": [
        "Cybersecurity Analyst", "Ethical Hacker", "Penetration Tester",
        "Security Engineer", "Network Security Engineer", "Information Security Analyst",
        "IT Support Specialist", "System Administrator", "Network Administrator",
        "Cloud Security Engineer", "Incident Response Analyst",
    ],
    "Cloud Computing & DevOps": [
        "Cloud Engineer", "AWS Solutions Architect", "Azure Engineer",
        "Site Reliability Engineer", "SRE", "Kubernetes Engineer",
        "Cloud Infrastructure Engineer", "Platform Engineer",
        "IT Operations Engineer", "DevOps Manager", "Cloud Consultant",
    ],
    "Software Testing & Quality Assurance": [
        "QA Engineer", "Software Tester", "Test Automation Engineer",
        "Performance Tester", "Quality Assurance Analyst",
    ],
    "Database & Backend Technologies": [
        "Database Administrator", "DBA", "SQL Developer",
        "NoSQL Database Engineer", "Data Warehouse Engineer", "ETL Developer",
    ],
    "IT Project Management & Business Analysis": [
        "IT Project Manager", "Scrum Master", "Agile Coach",
        "Business Analyst", "Product Manager",
    ],
    "Other IT & Engineering Roles": [
        "UI/UX Designer", "Technical Writer", "Embedded Software Engineer",
        "IT Consultant", "IT Auditor",
    ],
}
SEARCH_URL = ("https://www.flexjobs.com/search?searchkeyword=", "&usecLocation=true")

# Words that mark a card tag as the salary, in the lower tag.
SALARY_TAG_WORDS = ["salary", "usd", "annually", "hourly", "$"]

# Texts of an empty result page and of a link to the next page.
NO_RESULT_TEXTS = ["No jobs found", "No Results Found"]
NEXT_LINK_TEXTS = ["Next", "→", "»"]

# Sizes.
CARDS_PER_PAGE = 100
CARDS_PER_PREVIEW = 3
HISTOGRAM_BINS = 30
DENSITY_POINTS = 200
SCATTER_SAMPLE = 100
ROLES_EXPLAINED = 5
MIN_ROLE_ROWS = 10
SPLIT_SEED = 42
WHISKER = 1.5
