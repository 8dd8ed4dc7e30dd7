"""Customers: individuals and businesses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...config import RunContext
from ...functions import bands, masking
from ...functions.casting import project
from ...functions.keys import surrogate
from ...functions.text import EMAIL_PATTERN
from ...operators.dedup import latest_by
from ...operators.groups import with_group_count
from ...operators.quality import Rule, required
from .common import BRONZE_META, kinds, silver_meta, today

SPEC = kinds(
    plain="customer_id",
    text="customer_type full_name marital_status ethnicity education_level occupation employer_name "
    "residential_address residential_postal_code commercial_address phone_number preferred_contact_method id_type "
    "id_number visa_type nationality tax_id_number government_role source_of_funds location_exposure financial_goal "
    "device_type capture_channel branch_id branch_name branch_city branch_province company_size "
    "industry_risk_rating next_of_kin guardian_customer_id",
    lower="email",
    upper="gender citizenship",
    date="birth_date expiry_date visa_expiry_date date_of_entry",
    double="annual_income risk_score company_age annual_turnover",
    int="number_of_employees directors_count shareholders_count beneficial_owners_count bee_level",
    boolean="passport_expired is_pep sanctioned_country is_government_official vat_registered is_affidavit",
)
MASKS = {
    "id_number": "hash", "tax_id_number": "hash", "residential_address": "hash", "commercial_address": "hash",
    "next_of_kin": "hash", "email": "email", "phone_number": "phone",
}

# fixed values: bands, segments and prefixes
AGE_EDGES, AGE_LABELS = (25, 35, 45, 55, 65), ("18-24", "25-34", "35-44", "45-54", "55-64", "65+")
RISK_EDGES, RISK_LABELS = (0.3, 0.6, 0.8), ("Low", "Medium", "High", "Critical")
INCOME_EDGES = (50_000, 200_000, 500_000, 1_000_000)
INCOME_LABELS = (
    "Low (<50k)", "Lower-Middle (50k-200k)", "Middle (200k-500k)", "Upper-Middle (500k-1M)", "High (1M+)",
)
TENURE_EDGES, TENURE_LABELS = (1, 3, 5), ("New", "Growing", "Established", "Loyal")
COMPLETENESS_EDGES, COMPLETENESS_LABELS = (2, 4), ("Poor", "Moderate", "Complete")
SEGMENT_EDGES, SEGMENT_LABELS = (200_000, 1_000_000), ("Entry Level", "Mass Market", "Affluent")
BUSINESS_EDGES = (1_000_000, 10_000_000)
BUSINESS_LABELS = ("Small Business", "Medium Business", "Large Enterprise")
PHONE_PREFIXES = {"+27": "ZA", "+254": "KE", "+266": "LS", "+263": "ZW"}
HOME_CITIZENSHIPS = ("ZA", "South Africa")
DIGITAL_CHANNELS = ("mobile app", "online banking", "web", "internet banking")
CENTURY_SHIFT_MONTHS, MIN_AGE, MAX_AGE = 960, 0, 120
FIRST_BIRTH_YEAR, LAST_BIRTH_YEAR = 1910, 2030
PARTS = {"individual": ("Individual",), "non_individual": ("Company", "Organization")}
SCORED = ("email", "phone_number", "id_number", "residential_address", "annual_income", "risk_score")


def null_rules() -> list[Rule]:
    """Required for all, for individuals, for businesses."""
    individual = F.col("customer_type") == "Individual"
    return [
        *required("customer_id customer_type full_name risk_score branch_id".split()),
        *required(
            "birth_date gender marital_status id_type id_number citizenship nationality annual_income "
            "education_level ethnicity location_exposure financial_goal".split(), "warn", individual,
        ),
        *required(
            "company_size annual_turnover directors_count shareholders_count vat_registered".split(), "warn",
            ~individual,
        ),
    ]


def age_band(age: Column | str) -> Column:
    return bands.band(age, AGE_EDGES, AGE_LABELS, null_label="Unknown")


def risk_tier(score: Column | str) -> Column:
    return bands.band(score, RISK_EDGES, RISK_LABELS, null_label="Unscored")


def income_band(income: Column | str) -> Column:
    return bands.band(income, INCOME_EDGES, INCOME_LABELS, null_label="Unknown")


def segment(income: Column | str) -> Column:
    """Individuals; an unknown income counts as entry level."""
    return bands.band(income, SEGMENT_EDGES, SEGMENT_LABELS, null_label="Entry Level")


def business_segment(turnover: Column | str) -> Column:
    return bands.band(turnover, BUSINESS_EDGES, BUSINESS_LABELS)


def phone_country(phone: Column | str) -> Column:
    c = F.col(phone) if isinstance(phone, str) else phone
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for prefix, country in PHONE_PREFIXES.items():
        out = out.when(c.startswith(prefix), country)
    return out.otherwise("OTHER")


def shift_birth_dates(df: DataFrame, day: Column) -> DataFrame:
    """Two-digit-year repair for individuals: negative ages move back 80 years, ages above 120 forward."""
    individual = F.col("customer_type") == "Individual"
    age = F.floor(F.months_between(day, F.col("birth_date")) / 12)
    moved = (
        F.when(individual & (age < MIN_AGE), F.add_months("birth_date", -CENTURY_SHIFT_MONTHS))
        .when(individual & (age > MAX_AGE), F.add_months("birth_date", CENTURY_SHIFT_MONTHS))
        .otherwise(F.col("birth_date"))
    )
    fixed_age = F.floor(F.months_between(day, moved) / 12)
    unlikely = individual & ((fixed_age < MIN_AGE) | (fixed_age > MAX_AGE))
    return df.withColumns({
        "dq_birth_date_suspect": F.coalesce(unlikely, F.lit(False)),
        "dq_birth_date_corrected": F.coalesce(individual & (F.col("birth_date") != moved), F.lit(False)),
        "birth_date": moved,
    })


def birth_date_by_year(birth_date: Column | str) -> Column:
    """The repair of the profiling report: judged by the year of birth, not by the age."""
    d = F.col(birth_date) if isinstance(birth_date, str) else birth_date
    return (
        F.when(F.year(d) > LAST_BIRTH_YEAR, F.add_months(d, -CENTURY_SHIFT_MONTHS))
        .when(F.year(d) < FIRST_BIRTH_YEAR, F.add_months(d, CENTURY_SHIFT_MONTHS))
        .otherwise(d)
    )


def customers(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    """All customers; :func:`split_customers` makes the two published tables."""
    day = today(ctx)
    newest = latest_by(bronze, ["customer_id"], ["year", "month", "_ingest_timestamp"])
    clean = shift_birth_dates(project(newest, SPEC, keep=BRONZE_META), day)
    # the national id starts with the birth date: compare before masking
    national = (F.col("id_type") == "National ID") & F.col("id_number").isNotNull() & F.col("birth_date").isNotNull()
    clean = clean.withColumn(
        "id_dob_match", F.when(national, F.substring("id_number", 1, 6) == F.date_format("birth_date", "yyMMdd"))
    )
    masked = masking.mask(clean, MASKS, ctx.salt)
    home = F.col("citizenship").isin(*HOME_CITIZENSHIPS)
    passport = (F.col("id_type") == "Passport") & F.col("expiry_date").isNotNull()
    first = masked.withColumns({
        "age": bands.years_by_days("birth_date", day),
        "customer_tenure_years": bands.years_by_days(F.to_date("_ingest_timestamp"), day),
        "is_foreign_national": ~home,
        "is_dual_citizen": F.coalesce(F.col("citizenship").contains(","), F.lit(False)),
        "primary_citizenship": F.trim(F.get(F.split("citizenship", ","), F.lit(0))),
        "kyc_risk_tier": risk_tier("risk_score"),
        "income_band": income_band("annual_income"),
        "passport_valid": F.when(passport, F.col("expiry_date") > day),
        "visa_valid": F.col("visa_expiry_date") > day,
        "is_valid_email": F.col("email").rlike(EMAIL_PATTERN),
        "phone_country_code": phone_country("phone_number"),
        "is_digital_customer": F.coalesce(F.lower("capture_channel").isin(*DIGITAL_CHANNELS), F.lit(False)),
        "completeness_score": bands.score(bands.present(SCORED)),
        "customer_segment": F.when(F.col("customer_type") == "Individual", segment("annual_income")),
        "business_segment": business_segment("annual_turnover"),
        "segmentation_ready": bands.all_of(bands.present(["risk_score", "citizenship", "customer_type"])),
        "customer_sk": surrogate("customer_id"),
    })
    second = first.withColumns({
        "age_band": age_band("age"),
        "tenure_band": bands.band("customer_tenure_years", TENURE_EDGES, TENURE_LABELS, null_label="Loyal"),
        # a three-valued OR: unknown inputs leave it unknown
        "is_high_risk": bands.any_of([
            F.col("is_pep"), F.col("sanctioned_country"), F.col("kyc_risk_tier") == "Critical",
        ]),
        "completeness_band": bands.band("completeness_score", COMPLETENESS_EDGES, COMPLETENESS_LABELS, closed="right"),
        "income_risk_profile": F.concat_ws("_", "income_band", "kyc_risk_tier"),
    })
    third = second.withColumn("risk_segment", F.when(F.col("is_high_risk"), "High Risk").otherwise("Standard Risk"))
    return silver_meta(third, "bronze_customers", ctx)


# fixed values: columns that only the table of individuals carries
INDIVIDUAL_ONLY = (
    "birth_date", "age", "age_band", "gender", "marital_status", "ethnicity", "education_level", "occupation",
    "employer_name", "annual_income", "income_band", "customer_segment", "is_foreign_national", "primary_citizenship",
    "is_dual_citizen", "id_type", "id_number", "id_dob_match", "expiry_date", "passport_expired", "passport_valid",
    "visa_type", "visa_expiry_date", "visa_valid", "date_of_entry", "financial_goal", "device_type", "next_of_kin",
    "guardian_customer_id",
)
# fixed values: columns that only the table of businesses carries
BUSINESS_ONLY = (
    "business_segment", "company_age", "company_size", "number_of_employees", "annual_turnover", "directors_count",
    "shareholders_count", "beneficial_owners_count", "bee_level", "vat_registered", "industry_risk_rating",
)


def split_customers(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(individuals with a duplicate-e-mail flag, businesses)."""
    person = silver.filter(F.col("customer_type").isin(*PARTS["individual"])).drop(*BUSINESS_ONLY, "year", "month")
    firm = silver.filter(F.col("customer_type").isin(*PARTS["non_individual"])).drop(*INDIVIDUAL_ONLY, "year", "month")
    person = with_group_count(person, ["email"], "__same", where=F.col("email").isNotNull())
    return person.withColumn("is_duplicate_email", F.col("__same") > 1).drop("__same"), firm
