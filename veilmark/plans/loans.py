"""Loan records: applicants out of applications, and the flat tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import latest, nested

# Applicant columns that move behind the others.
APPLICANT_TAIL = ("address", "bank_iban", "last_name", "post_code", "first_name", "phone", "email", "ssn", "city")


def applicants(raw: DataFrame) -> DataFrame:
    """Applicants of every application, their employments re-nested per applicant.

    An application without applicants stays as one row of NULLs.  Employments
    of one applicant are gathered over all rows that carry its id, with the
    employer last in each struct; an applicant without any has NULL.
    """
    data_id = F.col("data_id")
    rows = nested.unnest(
        raw.select("data_id", "applicants"), "applicants", "left", lambda a: a.getField("data_id") == data_id, "c"
    ).select("c.*")
    head = [c for c in rows.columns if c not in APPLICANT_TAIL]
    people = rows.select(*head, *[c for c in APPLICANT_TAIL if c in rows.columns])

    members = [f.name for f in people.schema["employments"].dataType.elementType.fields]
    ordered = [m for m in members if m != "employer"] + ["employer"]
    owner = F.col("id")
    own = nested.unnest(
        people.select("id", "employments"), "employments", "left", lambda e: e.getField("applicant_id") == owner, "e"
    )
    entry = F.struct(*[F.col(f"e.{m}").alias(m) for m in ordered])
    # Unmatched parents fall into the group without id and never join back.
    per_person = (
        own.filter(F.col("e").isNotNull())
        .groupBy(F.col("e.applicant_id").alias("__id"))
        .agg(F.array_sort(F.collect_list(entry)).alias("employments"))
    )
    return people.drop("employments").join(per_person, F.col("id") == F.col("__id"), "left").drop("__id")


def drop_applicants(raw: DataFrame) -> DataFrame:
    """Applications without their applicants."""
    return nested.star_except(raw, "applicants")


def _stamp(path: str) -> Column:
    return F.col(path).cast("timestamp")


# Per child array of an applicant, the published names of its members.
CHILD_MEMBERS = {
    "cards": {
        "card_id": "id",
        "card_created_at": "created_at",
        "card_issuer": "issuer",
        "card_type": "card_type",
        "card_debt": "debt",
        "card_limit": "limit",
    },
    "consents": {
        "consent_id": "id",
        "consent_created_at": "created_at",
        "consent_accepted_at": "accepted_datetime",
        "consent_type": "consent_type",
    },
    "financials": {
        "financial_id": "id",
        "financial_created_at": "created_at",
        "financial_description": "description",
        "financial_issuer": "issuer",
        "financial_amount_monthly": "amount_monthly",
        "financial_money_type": "money_type",
        "financial_consolidation": "consolidation",
        "financial_amount": "amount",
        "financial_finance_source": "finance_source",
        "financial_finance_type": "finance_type",
    },
    "housings": {
        "housing_id": "id",
        "housing_created_at": "created_at",
        "housing_moving_date": "moving_date",
        "housing_property_type": "property_type",
        "housing_property_area": "property_area",
        "housing_residency_type": "residency_type",
    },
    "employments": {
        "employment_id": "id",
        "employment_created_at": "created_at",
        "employment_area": "profession_area",
        "employment_profession": "profession",
        "employment_profession_class": "profession_class",
        "is_current_employment": "is_current",
        "employment_start_date": "start_date",
        "employment_business_id": "business_id",
        "employment_occupation": "occupation",
        "employer": "employer",
        "employment_end_date": "end_date",
    },
}
# Applicant members and spouse members.
APPLICANT_MEMBERS = (
    "is_main_applicant",
    "first_name",
    "last_name",
    "gender",
    "dob",
    "age",
    "phone",
    "email",
    "ssn",
    "marital_status",
    "dependents",
    "city",
    "post_code",
    "address",
    "education",
    "citizenship",
    "has_summer_house",
    "is_pep",
    "military",
    "adults",
    "bank_bic",
    "bank_iban",
    "has_credit_remarks",
    "is_anonymized",
)
SPOUSE_MEMBERS = {
    "spouse_id": "id",
    "spouse_created_at": "created_at",
    "spouse_monthly_expenses": "monthly_expenses",
    "spouse_salary_monthly_net": "salary_monthly_net",
    "spouse_salary_monthly_gross": "salary_monthly_gross",
}
# Published members that are times.
TIMES = (
    "card_created_at",
    "consent_created_at",
    "financial_created_at",
    "housing_created_at",
    "employment_created_at",
    "spouse_created_at",
)


def _published(df: DataFrame, struct: str, members: Mapping[str, str]) -> list[Column]:
    columns = []
    for name, member in members.items():
        value = nested.member(df.schema, f"{struct}.{member}")
        columns.append((value.cast("timestamp") if name in TIMES else value).alias(name))
    return columns


def _children(df: DataFrame, array: str, alias: str) -> DataFrame:
    owner = F.col("id")
    return nested.unnest(df, array, "left", lambda e: e.getField("applicant_id") == owner, alias)


def _applicant_keys(try_cast: bool = False) -> list[Column]:
    created = clean.safe_timestamp(F.col("created_at")) if try_cast else _stamp("created_at")
    return [
        F.col("data_id").cast("string").alias("data_id"),
        created.alias("applicant_created_at"),
        F.col("id").alias("applicant_id"),
    ]


def applicant_child(df: DataFrame, name: str) -> DataFrame:
    """Cards, consents or financials: every applicant stays, with NULLs when it has none."""
    rows = _children(df.select("data_id", "created_at", "id", name), name, "e")
    return rows.select(*_applicant_keys(), *_published(rows, "e", CHILD_MEMBERS[name]))


def applicant_table(df: DataFrame) -> DataFrame:
    """Applicants by housing and employment (all combinations of the two)."""
    rows = _children(_children(df, "housings", "h").drop("housings"), "employments", "e")
    return rows.select(
        *_applicant_keys(try_cast=True),
        *[nested.member(df.schema, m).alias(m) for m in APPLICANT_MEMBERS],
        *_published(rows, "spouse", SPOUSE_MEMBERS),
        *_published(rows, "h", CHILD_MEMBERS["housings"]),
        *_published(rows, "e", CHILD_MEMBERS["employments"]),
    )


# Application members, their published names, and struct members.
APPLICATION_MEMBERS = {
    "application_subid": "subid",
    "application_subid2": "subid2",
    "application_subid3": "subid3",
    "application_subid4": "subid4",
    "application_subid5": "subid5",
    "ip_address": "ip",
    "loan_purpose": "loanpurpose",
    "repayment_time": "repaymenttime",
    "loan_amount": "loanamount",
    "cancelled": "cancelled",
    "decision": "decision",
    "submit_loan": "submit_loan",
    "sent": "sent",
    "visit_id": "visit_id",
    "status": "status",
    "hide_application": "hide_application",
    "data_md5": "datamd5",
    "processed": "processed",
    "source_brand_id": "brand_id",
    "offers": "offers",
}
VISIT_MEMBERS = {
    "visit_subid": "subid",
    "visit_subid2": "subid2",
    "visit_subid3": "subid3",
    "visit_subid4": "subid4",
    "visit_subid5": "subid5",
    "visit_updated_at": "timestamp",
    "visit_created_at": "created_at",
    "visit_google_client_id": "google_client_id",
    "visit_hostname": "hostname",
    "visit_hostname2": "hostname2",
    "visit_ip_address2": "ip_address2",
    "visit_maxloan": "maxloan",
    "visit_campaign_group": "campaign_group",
    "visit_campaign_term": "campaign_term",
    "visit_ip_address": "ip_address",
    "visit_md5": "md5",
    "visit_referral": "referral",
    "visit_campaign": "campaign",
    "visit_agent": "agent",
    "visit_device_type": "device_type",
    "visit_brand": "brand",
}
BRAND_MEMBERS = {
    "brand_id": "id",
    "brand_http_auth": "http_auth",
    "brand_double_redirect_url": "double_redirect_url",
    "brand_status_url": "status_url",
    "brand_reject_redirect_url": "reject_redirect_url",
    "brand_google_ua": "google_ua",
    "brand_is_active": "is_active",
    "brand_has_affiliate_sales": "has_affiliate_sales",
    "brand_settings": "settings",
    "brand_is_cpl": "is_cpl",
    "brand_is_visible": "visible",
    "brand_is_omatili": "is_omatili",
    "brand_house": "house",
    "brand_domain": "domain",
    "brand_url": "url",
    "brand_omatili_url": "omatili_url",
}


def applications(raw: DataFrame) -> DataFrame:
    """Applications with visit and brand flattened."""
    schema = raw.schema
    return raw.select(
        F.col("data_id").cast("string").alias("data_id"),
        _stamp("timestamp").alias("application_created_at"),
        clean.safe_timestamp(nested.member(schema, "processed_datetime")).alias("application_processed_at"),
        clean.safe_timestamp(nested.member(schema, "last_activity_datetime")).alias("last_activity_datetime"),
        *[nested.member(schema, m).alias(n) for n, m in APPLICATION_MEMBERS.items()],
        *[nested.member(schema, f"visit.{m}").alias(n) for n, m in VISIT_MEMBERS.items()],
        *[nested.member(schema, f"brand.{m}").alias(n) for n, m in BRAND_MEMBERS.items()],
        nested.member(schema, "brand.brand").alias("brand"),
    )


def commissions(raw: DataFrame) -> DataFrame:
    """Commissions of applications; applications without one do not appear."""
    rows = nested.unnest(raw.select("data_id", "timestamp", "commissions"), "commissions", alias="c")
    return rows.select(
        F.col("data_id").cast("string").alias("data_id"),
        _stamp("timestamp").alias("application_created_at"),
        F.to_date("c.effective_date").alias("effective_date"),
        F.col("c.value").alias("commission_value"),
        F.col("c.bank_id").alias("commission_bank_id"),
        F.col("c.type").alias("commission_type"),
    )


OFFER_TIMES = ("api_approved_datetime", "approved_datetime", "paid_datetime")
# Published offer columns.
OFFER_COLUMNS = (
    "data_id",
    "incremental_datetime",
    "api_approved_datetime",
    "application",
    "user_selected_datetime",
    "approved",
    "api_approved",
    "badges",
    "esign_link",
    "bank_id",
    "is_new_for_provider",
    "paid",
    "apr",
    "approved_amount",
    "approved_datetime",
    "interest_rate",
    "administration_fee",
    "opening_fee",
    "status",
    "monthly_payment",
    "repayment_amount",
    "repayment_time",
    "esign_info",
    "consolidation_amount",
    "topup_amount",
    "esign_txt",
    "paid_datetime",
)


def _timed_offers(raw: DataFrame) -> DataFrame:
    timed = raw.withColumns({c: clean.safe_timestamp(F.col(c)) for c in OFFER_TIMES})
    newest = F.coalesce("paid_datetime", "approved_datetime", "api_approved_datetime")
    return timed.withColumn("incremental_datetime", newest).withColumn("data_id", F.col("data_id").cast("string"))


def offers(raw: DataFrame) -> DataFrame:
    """Distinct offers; the incremental time is the first of paid, approved, api-approved."""
    timed = _timed_offers(raw).withColumn("bank_id", F.col("bank_id").cast("string"))
    return timed.select(*[nested.member(timed.schema, c).alias(c) for c in OFFER_COLUMNS]).distinct()


def offer_states(raw: DataFrame) -> DataFrame:
    """Distinct states of offers; an offer without states stays with NULLs."""
    timed = _timed_offers(raw.select("data_id", *OFFER_TIMES, "states"))
    rows = nested.unnest(timed, "states", "left", alias="s")
    members = [f.name for f in rows.schema["s"].dataType.fields if f.name != "data_id"]
    return rows.select("data_id", "incremental_datetime", *[F.col(f"s.{m}").alias(m) for m in members]).distinct()


def clients(raw: DataFrame, market: Column | str) -> DataFrame:
    """Clients with consents expanded and the national id normalised."""
    flat = nested.expand(raw, "consents")
    cleaned = clean.national_id(F.col("ssn"), market, zero_to_null=True, fallback_digits=True)
    return flat.withColumn("national_id", cleaned).drop("ssn")


# Payment rules of a provider.
CPL_RULES = {"cpl_approved": "approved", "cpl_api_approved": "APIapproved", "cpl_paid": "paid"}


def providers(raw: DataFrame, path: str = "file_name", segments: Sequence[int] = (4, 5, 6)) -> DataFrame:
    """Provider from its newest file, with rule flags."""
    dated = raw.withColumn("dedupe_date", clean.date_from_path(F.col(path), tuple(segments)))
    newest = latest.latest_by(dated, ["id"], [F.col("dedupe_date").desc()], [F.col(path).desc()]).drop(path)
    rules = F.coalesce(F.col("cpl_rules"), F.array().cast("array<string>"))
    flags = [F.array_contains(rules, value).alias(name) for name, value in CPL_RULES.items()]
    others = [c for c in newest.columns if c not in ("cpl_rules", "commissions")]
    return newest.select(*flags, *others)


def provider_commissions(raw: DataFrame) -> DataFrame:
    """Commission members of providers; a provider without one stays as NULLs."""
    return nested.unnest(raw.select("commissions"), "commissions", "left", alias="c").select("c.*")


# Published credit remark columns.
REMARK_COLUMNS = (
    "ssn_id",
    "name",
    "bisnode_id",
    "payment_remark_latest",
    "payment_remarks_count",
    "other_remarks_count",
    "is_under_guardianship",
    "is_banned_on_business_operations",
    "last_check",
)


def credit_remarks(raw: DataFrame) -> DataFrame:
    return raw.withColumn("last_check", _stamp("last_check")).select(*REMARK_COLUMNS)
