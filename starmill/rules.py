"""Word lists, maps and column lists the operators take as parameters.

Every list here is a fixed value: results depend on its spelling and on its order.
"""

from __future__ import annotations

# --- fixed values: columns -------------------------------------------------------------

BRONZE_COLUMNS = [
    "source",
    "job_title",
    "company",
    "city",
    "location",
    "employment_type",
    "salary",
    "skills",
    "experience_level",
    "apply_link",
    "posted_at",
    "fetched_at",
    "description",
]

# Columns whose whitespace is normalised.
TEXT_COLUMNS = [
    "source",
    "job_title",
    "company",
    "city",
    "location",
    "employment_type",
    "skills",
    "experience_level",
    "apply_link",
]

SILVER_TYPES = {
    "source": "string",
    "job_title": "string",
    "company": "string",
    "city": "string",
    "location": "string",
    "employment_type": "string",
    "skills": "string",
    "experience_level": "string",
    "apply_link": "string",
    "posted_at": "timestamp",
    "fetched_at": "timestamp",
    "description": "string",
    "is_remote": "boolean",
    "has_salary": "boolean",
    "posted_date": "date",
    "posted_year": "bigint",
    "posted_month": "bigint",
    "posted_day": "bigint",
}

GOLD_INPUT_COLUMNS = [
    "SOURCE",
    "JOB_TITLE",
    "COMPANY",
    "CITY",
    "LOCATION",
    "EMPLOYMENT_TYPE",
    "SKILLS",
    "EXPERIENCE_LEVEL",
    "APPLY_LINK",
    "POSTED_AT",
    "DESCRIPTION",
    "IS_REMOTE",
    "HAS_SALARY",
    "POSTED_DATE",
    "POSTED_YEAR",
    "POSTED_MONTH",
    "POSTED_DAY",
]

# A posting without a usable link is identified by these.
POSTING_KEY = ["job_title", "company", "location"]

# --- fixed values: tokens and maps -----------------------------------------------------

PLACEHOLDER = "N/A"
SOURCE_TAG = "JSearch"
COUNTRY_NAMES = {"SA": "Saudi Arabia"}

NULL_TOKENS = ["N/A", "NA", "None", "NULL", ""]

EMPLOYMENT_TYPES = {
    "full-time": "Full-time",
    "full time": "Full-time",
    "fulltime": "Full-time",
    "part-time": "Part-time",
    "part time": "Part-time",
    "parttime": "Part-time",
    "contract": "Contract",
    "internship": "Internship",
    "temporary": "Temporary",
}

LEVELS = [
    "Intern",
    "Junior",
    "Mid Level",
    "Senior",
    "Senior Lead",
    "Lead",
    "Manager",
    "Director",
    "Principal",
]

# --- fixed values: dictionaries searched in text ---------------------------------------

SKILL_TERMS = [
    "Manual Testing", "Automation Testing", "Selenium", "TestNG", "JUnit", "Postman",
    "API Testing", "Regression Testing", "Test Cases", "QA", "Quality Assurance", "Cypress",
    "Appium", "Load Testing", "Performance Testing", "Bug Tracking",
    "Test Automation Framework",
    "SQL", "Python", "Excel", "Power BI", "Tableau", "Data Analysis", "Data Analytics",
    "Data Visualization", "ETL", "Machine Learning", "Data Cleaning", "Pandas", "NumPy", "R",
    "Statistics", "Spark", "PySpark", "Databricks", "Snowflake",
    "Java", "JavaScript", "TypeScript", "C++", "C#", "Node.js", "React", "REST API", "Git",
    "GitHub",
    "Docker", "Kubernetes", "AWS", "Azure", "GCP", "Linux", "DevOps", "CI/CD",
    "Agile", "Scrum", "Jira",
    "Cybersecurity", "Information Security", "Network Security",
]

CITIES = [
    "Riyadh", "Jeddah", "Makkah", "Mecca", "Madinah", "Medina", "Dammam", "Khobar",
    "Al Khobar", "Dhahran", "Taif", "Tabuk", "Abha", "Jubail", "Yanbu", "Najran", "Jizan",
    "Buraidah", "Hafar Al-Batin",
]

# --- fixed values: relative posting times ----------------------------------------------

# Whole-cell phrases -> seconds before the fetch time.
RELATIVE_PHRASES = {
    "الآن": 0,
    "اليوم": 0,
    "قبل قليل": 0,
    "أمس": 86_400,
    "امس": 86_400,
    "قبل يوم": 86_400,
    "قبل يوم واحد": 86_400,
    "قبل يومين": 2 * 86_400,
    "قبل أسبوع": 7 * 86_400,
    "قبل اسبوع": 7 * 86_400,
    "قبل أسبوعين": 14 * 86_400,
    "قبل اسبوعين": 14 * 86_400,
}

RELATIVE_PREFIX = "قبل"

# Counted units, in the order they are tried: words -> seconds per unit.
RELATIVE_UNITS = [
    (["دقيقة", "دقائق"], 60),
    (["ساعة", "ساعات"], 3_600),
    (["يوم", "أيام", "ايام"], 86_400),
    (["أسبوع", "اسبوع", "أسابيع", "اسابيع"], 7 * 86_400),
]

ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"

FETCHED_AT_FORMAT = "yyyy-MM-dd HH:mm:ss"
