"""Lookup tables, ordinal and dummy encodings, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.numeric import as_col
from starloom.functions.text import strip

UNKNOWN = "Unknown"

# US state names and their two-letter codes.
STATE_CODES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA", "Colorado": "CO",
    "Connecticut": "CT", "Delaware": "DE", "District of Columbia": "DC", "Florida": "FL", "Georgia": "GA",
    "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL", "Indiana": "IN", "Iowa": "IA", "Kansas": "KS", "Kentucky": "KY",
    "Louisiana": "LA", "Maine": "ME", "Maryland": "MD", "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN",
    "Mississippi": "MS", "Missouri": "MO", "Montana": "MT", "Nebraska": "NE", "Nevada": "NV", "New Hampshire": "NH",
    "New Jersey": "NJ", "New Mexico": "NM", "New York": "NY", "North Carolina": "NC", "North Dakota": "ND",
    "Ohio": "OH", "Oklahoma": "OK", "Oregon": "OR", "Pennsylvania": "PA", "Rhode Island": "RI",
    "South Carolina": "SC", "South Dakota": "SD", "Tennessee": "TN", "Texas": "TX", "Utah": "UT", "Vermont": "VT",
    "Virginia": "VA", "Washington": "WA", "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}

# Ordinal codes of experience levels and company size bands.
EXPERIENCE_CODES = {
    "Unknown": -1, "Internship": 0, "Entry level": 1, "Associate": 2, "Mid-Senior level": 3, "Director": 4,
    "Executive": 5,
}
COMPANY_SIZE_CODES = {
    "Unknown": 0, "1-10": 1, "11-50": 2, "51-200": 3, "201-500": 4, "501-1000": 5, "1001-5000": 6, "5001-10000": 7,
    "10001+": 8,
}

# Display names of category codes.
CATEGORY_LABELS = {
    "ACCT": "Accounting", "ADM": "Administration", "ANLS": "Analytics", "BD": "Business Dev", "CNSL": "Consulting",
    "CUST": "Customer Service", "EDU": "Education", "ENG": "Engineering", "FIN": "Finance", "HCPR": "Healthcare",
    "HR": "Human Resources", "IT": "Info Technology", "LGL": "Legal", "MGMT": "Management", "MNFC": "Manufacturing",
    "MRKT": "Marketing", "OTHR": "Other", "PRJM": "Project Mgmt", "RSCH": "Research", "SALE": "Sales",
}
CLUSTER_LABELS = CATEGORY_LABELS | {
    "ADVR": "Advertising", "DSGN": "Design", "GENB": "General Business", "HR": "Human Res", "PROD": "Product",
    "SCI": "Science", "STRA": "Strategy", "SUPL": "Supply Chain", "TRNG": "Training", "WRT": "Writing",
}
RULE_LABELS = {
    code: CATEGORY_LABELS[code]
    for code in ("ACCT", "ANLS", "BD", "ENG", "FIN", "HCPR", "IT", "MGMT", "MNFC", "MRKT", "SALE")
}

# Display names of model features in the regression chart.
REGRESSION_LABELS = {
    "skill_count": "Skill count", "applies": "Applicant count", "views": "Job views", "apply_rate": "Apply rate",
    "experience_encoded": "Experience level", "company_size_encoded": "Company size", "is_remote": "Remote job",
    "is_senior_title": "Senior-level title", "work_FULL_TIME": "Full-time", "work_PART_TIME": "Part-time",
    "work_CONTRACT": "Contract", "work_INTERNSHIP": "Internship", "work_TEMPORARY": "Temporary",
    "work_OTHER": "Other work type", "work_VOLUNTEER": "Volunteer",
}

# Display names of model features in the classification chart.
CLASSIFICATION_LABELS = {
    "skill_count": "Skill count", "views": "Job views", "apply_rate": "Apply rate (applies/views)",
    "experience_encoded": "Experience level", "company_size_encoded": "Company size", "is_remote": "Remote job",
    "is_senior_title": "Senior-level title", "high_salary": "High salary (top 25%)",
    "work_FULL_TIME": "Work type: Full-time", "work_PART_TIME": "Work type: Part-time",
    "work_CONTRACT": "Work type: Contract", "work_INTERNSHIP": "Work type: Internship",
    "work_TEMPORARY": "Work type: Temporary", "work_OTHER": "Work type: Other", "work_VOLUNTEER": "Work type: Volunteer",
}


def _literal(value: str | int) -> str:
    if isinstance(value, int):
        return str(value)
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def literal_map(mapping: Mapping[str, str | int]) -> Column:
    """Constant map, parsed in one call instead of one call per entry."""
    entries = ", ".join(_literal(x) for x in chain.from_iterable(mapping.items()))
    return F.expr(f"map({entries})")


def lookup(c: Column | str, mapping: Mapping, default) -> Column:
    """Value of the mapping, the default for NULL and unmapped keys."""
    c = as_col(c)
    default = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.when(c.isNotNull(), F.try_element_at(literal_map(mapping), c)), default)


def ordinal(c: Column | str, codes: Mapping[str, int], default: int) -> Column:
    return lookup(c, codes, default).cast("int")


def label(c: Column | str, labels: Mapping[str, str] = CATEGORY_LABELS) -> Column:
    """Display name of a code; unknown codes pass through."""
    return lookup(c, labels, as_col(c))


def set_label(items: Column | str, labels: Mapping[str, str] = RULE_LABELS, sep: str = " + ") -> Column:
    return F.array_join(F.transform(F.array_sort(as_col(items)), lambda x: label(F.trim(x), labels)), sep)


def feature_label(c: Column | str, labels: Mapping[str, str] = REGRESSION_LABELS) -> Column:
    """Listed display name, else the column name in title case."""
    return lookup(c, labels, F.initcap(F.replace(as_col(c), F.lit("_"), F.lit(" "))))


def region_code(c: Column | str, codes: Mapping[str, str] = STATE_CODES, unknown: str = UNKNOWN) -> Column:
    """Two-letter code of a region given by name or code; anything else is unknown."""
    key = strip(F.coalesce(as_col(c), F.lit(unknown)))
    code = lookup(key, codes, key)
    return F.when(code.rlike(r"^[A-Z]{2}$"), code).otherwise(F.lit(unknown))


def dummies(c: Column | str, values: Sequence[str], prefix: str) -> dict[str, Column]:
    """0/1 columns `<prefix>_<value>` for all sorted values but the first."""
    c = as_col(c)
    return {f"{prefix}_{v}": F.coalesce((c == v).cast("int"), F.lit(0)) for v in sorted(values)[1:]}
