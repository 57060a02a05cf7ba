"""Versioned nested documents to current tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import latest, nested
from ..operators.joins import lookup_join

DELETED = "delete"
# End of the unsubscription backlog and the database label.
UNSUBSCRIBED_BEFORE = "2022-01-01"
SOURCE_DATABASE = "mongodb"


@dataclass(frozen=True)
class Brands:
    """Brand naming of the document owner: the needle marks the second brand."""

    needle: str = "second"
    name: str = "second"
    otherwise: str = "first"


def live(df: DataFrame) -> DataFrame:
    """Versions that are not deletions; an unknown operation is dropped as well."""
    return df.filter(F.col("operationType") != DELETED)


def _derived(df: DataFrame, brands: Brands) -> DataFrame:
    """Columns added to every current document."""
    return df.withColumns(
        {
            "application_id": F.col("_id"),
            "versions": F.col("__v"),
            "updated_at": F.col("updatedAt"),
            "is_status_sent": nested.member(df.schema, "status.sent"),
            "brand": clean.brand(nested.member(df.schema, "utm.domain"), brands.needle, brands.name, brands.otherwise),
            "source_database": F.lit(SOURCE_DATABASE),
        }
    )


def _newest(raw: DataFrame, tiebreak: Sequence[Column], values: Mapping[str, Column], where: Column | None = None):
    """Pick of the newest live version; ties go by the caller's columns, then by the flat columns."""
    live_rows = F.col("operationType") != DELETED
    order = [*latest.version_key(), *tiebreak, latest.flat_hash(raw)]
    return latest.Pick.newest(order, values, live_rows if where is None else live_rows & where)


def latest_documents(raw: DataFrame, brands: Brands = Brands(), tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Newest live version per document, its loans repaired by the longest array seen.

    One scan and one shuffle: each task keeps one row per document for both choices, and columns that nobody reads are
    pruned down to the scan.  Versions that agree in number, both times and all flat columns tie; ``tiebreak`` (greatest
    first) decides between them where their nested values differ.  Write this once and derive the child tables from it.
    """
    raw = nested.empty_for_null(raw)
    values = {c: F.col(f"`{c}`") for c in raw.columns if c != "_id"}
    # The longest array may come from a deleted version as well; of equally long ones it is the greatest.
    longest = latest.Pick.newest([F.size("loans"), F.col("loans")], {"__longest": F.col("loans")})
    picks = [_newest(raw, tiebreak, values | {"__live": F.lit(True)}), longest]
    docs = latest.pick_by(raw, {"_id": F.col("_id")}, picks).filter("__live").drop("__live")
    docs = docs.withColumn("loans", nested.largest(F.col("__longest"), F.col("loans"))).drop("__longest")
    return _derived(docs.select(*raw.columns), brands)


# Published names of the application document's members, and where they are.
MEMBERS = {
    "bankEffectiveInterest": "acceptedBid.bankEffectiveInterest",
    "requires_extra_doc": "acceptedBid.requires_extra_doc",
    "effectiveInterest": "acceptedBid.effectiveInterest",
    "acceptedBiduser": "acceptedBid.placedBy.user",
    "acceptedBidname": "acceptedBid.placedBy.name",
    "acceptedBidintegrationAcceptSent": "acceptedBid.integrationAcceptSent",
    "signLink": "acceptedBid.signLink",
    "bankMonthlyCost": "acceptedBid.bankMonthlyCost",
    "mustRefinanceAmount": "acceptedBid.mustRefinanceAmount",
    "startupFee": "acceptedBid.startupFee",
    "accepted": "acceptedBid.accepted",
    "acceptedBidcomments": "acceptedBid.comments",
    "acceptedBidamount": "acceptedBid.amount",
    "acceptedBidbankNotInterested": "acceptedBid.bankNotInterested",
    "invitation": "acceptedBid.invitation",
    "fromInbox": "acceptedBid.fromInbox",
    "amortizationType": "acceptedBid.amortizationType",
    "acceptedBidId": "acceptedBid._id",
    "integrationAccentSent": "acceptedBid.integrationAccentSent",
    "companyBalanceSheet": "acceptedBid.requiredDocs.companyBalanceSheet",
    "ownCompanyBalance": "acceptedBid.requiredDocs.ownCompanyBalance",
    "rentalIncome": "acceptedBid.requiredDocs.rentalIncome",
    "employerDoc": "acceptedBid.requiredDocs.employerDoc",
    "retiredPaymentNotice": "acceptedBid.requiredDocs.retiredPaymentNotice",
    "companyMoreRecentProfitAndLossStatement": "acceptedBid.requiredDocs.companyMoreRecentProfitAndLossStatement",
    "taxReturn": "acceptedBid.requiredDocs.taxReturn",
    "companyProfitAndLossStatement": "acceptedBid.requiredDocs.companyProfitAndLossStatement",
    "payslip": "acceptedBid.requiredDocs.payslip",
    "companyBankStatements": "acceptedBid.requiredDocs.companyBankStatements",
    "companyAdditionalGuarantor": "acceptedBid.requiredDocs.companyAdditionalGuarantor",
    "acceptedBidBank": "acceptedBid.bank",
    "maximumAmount": "acceptedBid.maximumAmount",
    "acceptedBidrepaymentTime": "acceptedBid.repaymentTime",
    "acceptedBidexternalApplicationId": "acceptedBid.externalApplicationId",
    "acceptedBidinterest": "acceptedBid.interest",
    "adminFee": "acceptedBid.adminFee",
    "firstCallAnswered": "agentFeedback.firstCallAnswered",
    "partnerWhenPossible": "agentFeedback.partnerWhenPossible",
    "notPrepared": "agentFeedback.notPrepared",
    "noAnswer": "agentFeedback.noAnswer",
    "correctExpectations": "agentFeedback.correctExpectations",
    "noPartnerWhenPossible": "agentFeedback.noPartnerWhenPossible",
    "customerSatisfied": "agentFeedback.customerSatisfied",
    "firstCallNotAnswered": "agentFeedback.firstCallNotAnswered",
    "noInfoAboutLoan": "agentFeedback.noInfoAboutLoan",
    "infoAboutLoan": "agentFeedback.infoAboutLoan",
    "wrongExpectations": "agentFeedback.wrongExpectations",
    "ngrams": "company.ngrams",
    "yearlyRevenue": "company.yearlyRevenue",
    "address": "company.address",
    "monthlyRevenue": "company.monthlyRevenue",
    "entityType": "company.entityType",
    "postalCode": "company.postalCode",
    "industryTypeOther": "company.industryTypeOther",
    "companymarket": "company.market",
    "organizationNumber": "company.organizationNumber",
    "companyId": "company._id",
    "companyName": "company.name",
    "postalArea": "company.postalArea",
    "foundationDate": "company.foundationDate",
    "industryType": "company.industryType",
    "debtLettersigned": "debtLetter.signed",
    "name": "debtLetter.placedBy.name",
    "debtLetteramount": "debtLetter.amount",
    "debtLetteraccepted": "debtLetter.accepted",
    "debtLetterintegrationAcceptSent": "debtLetter.integrationAcceptSent",
    "debtLetterrepaymentTime": "debtLetter.repaymentTime",
    "debtLettersent": "debtLetter.sent",
    "debtLetterexternalApplicationId": "debtLetter.externalApplicationId",
    "debtLetteracceptedAt": "debtLetter.acceptedAt",
    "debtLetterId": "debtLetter._id",
    "debtLetterinterest": "debtLetter.interest",
    "debtLetterBank": "debtLetter.bank",
    "debtLetterbankNotInterested": "debtLetter.bankNotInterested",
    "lastPaidOutBy{owner}bank": "lastPaidOutBy{owner}.bank",
    "lastPaidOutBy{owner}date": "lastPaidOutBy{owner}.date",
    "lastPaidOutBy{owner}amount": "lastPaidOutBy{owner}.amount",
    "lifeInsurancesigned": "lifeInsurance.signed",
    "lifeInsurancenotInterested": "lifeInsurance.notInterested",
    "lifeInsurancesignedAt": "lifeInsurance.signedAt",
    "insuranceType": "lifeInsurance.insuranceType",
    "premium": "lifeInsurance.premium",
    "notInterestedReason": "lifeInsurance.notInterestedReason",
    "errorMessage": "lifeInsurance.errorMessage",
    "compensation": "lifeInsurance.compensation",
    "loanProtectionForPartnernotInterested": "loanProtectionForPartner.notInterested",
    "loanProtectionForPartneraccepted": "loanProtectionForPartner.accepted",
    "loanProtectionForPartneracceptedAt": "loanProtectionForPartner.acceptedAt",
    "loanProtectionForPartnersentToBank": "loanProtectionForPartner.sentToBank",
    "loanProtectionForPartnerperson": "loanProtectionForPartner.person",
    "loanProtectionForPersonnotInterested": "loanProtectionForPerson.notInterested",
    "loanProtectionForPersonaccepted": "loanProtectionForPerson.accepted",
    "loanProtectionForPersonacceptedAt": "loanProtectionForPerson.acceptedAt",
    "notApplicable": "loanProtectionForPerson.notApplicable",
    "loanProtectionForPersonsentToBank": "loanProtectionForPerson.sentToBank",
    "person": "loanProtectionForPerson.person",
    "agentId": "loxyStatus.agentId",
    "status": "loxyStatus.status",
    "loxyStatusdate": "loxyStatus.date",
    "mortgageInforefinanceMortgage": "mortgageInfo.refinanceMortgage",
    "propertyType": "mortgageInfo.propertyType",
    "daycare": "mortgageInfo.daycare",
    "propertyValue": "mortgageInfo.propertyValue",
    "monthlyCondoRent": "mortgageInfo.monthlyCondoRent",
    "cars": "mortgageInfo.cars",
    "otherIncomes": "mortgageInfo.otherIncomes",
    "localTaxes": "mortgageInfo.localTaxes",
    "condoRent": "mortgageInfo.condoRent",
    "partnerTrackingfp": "partnerTracking.adservice.fp",
    "hypetrafficcid": "partnerTracking.hypetraffic.cid",
    "transaction_id": "partnerTracking.responsefinance.transaction_id",
    "sgclid": "partnerTracking.swegaming.sgclid",
    "affid": "partnerTracking.smartresponse.affid",
    "reqid": "partnerTracking.smartresponse.reqid",
    "smartresponsecid": "partnerTracking.smartresponse.cid",
    "trygglancid": "partnerTracking.trygglan.cid",
    "uuid": "partnerTracking.unifinance.uuid",
    "at_gd": "partnerTracking.adtraction.at_gd",
    "cn": "partnerTracking.adtraction.cn",
    "cv": "partnerTracking.adtraction.cv",
    "signed": "paymentProtection.signed",
    "notInterested": "paymentProtection.notInterested",
    "CTF": "paymentProtection.qualified.CTF",
    "CFTF": "paymentProtection.qualified.CFTF",
    "paymentProtectionsignedAt": "paymentProtection.signedAt",
    "paymentProtectioninsuranceType": "paymentProtection.insuranceType",
    "paymentProtectionpremium": "paymentProtection.premium",
    "paymentProtectionnotInterestedReason": "paymentProtection.notInterestedReason",
    "paymentProtectionerrorMessage": "paymentProtection.errorMessage",
    "paymentProtectioncompensation": "paymentProtection.compensation",
    "paymentStatuspaidAccordingToBank": "paymentStatus.paidAccordingToBank",
    "paymentStatusBank": "paymentStatus.bank",
    "paidAccordingToCustomer": "paymentStatus.paidAccordingToCustomer",
    "randomtype": "random.type",
    "coordinates": "random.coordinates",
    "scheduled_call_date": "scheduledCall.date",
    "rejectionReasonForInsurance": "status.rejectionReasonForInsurance",
    "active": "status.active",
    "text": "status.text",
    "supplement": "status.supplement",
    "statussent": "status.sent",
    "deactivationReason": "status.deactivationReason",
    "statusdate": "status.date",
    "teamLeader": "teamAttributes.teamLeader",
    "team": "teamAttributes.team",
    "term": "utm.term",
    "cookieId": "utm.cookieId",
    "adposition": "utm.adposition",
    "medium": "utm.medium",
    "partner": "utm.partner",
    "content": "utm.content",
    "campaign": "utm.campaign",
    "device": "utm.device",
    "gaCookie": "utm.gaCookie",
    "campaignId": "utm.campaignId",
    "source": "utm.source",
    "domain": "utm.domain",
    "fbcCookie": "utm.fbcCookie",
    "fbpCookie": "utm.fbpCookie",
    "applicant_id": "person._id",
    "partner_id": "partner._id",
    "national_id": "person.idNumber",
}
# Bank account members published with the full history only.
HISTORY_MEMBERS = {
    "idNumber": "bankAccount.idNumber",
    "accountNumber": "bankAccount.accountNumber",
    "yearsWithBank": "bankAccount.yearsWithBank",
    "sinceYear": "bankAccount.sinceYear",
    "clearingNumber": "bankAccount.clearingNumber",
    "bankName": "bankAccount.bankName",
}
CURRENT_ONLY = ("fbcCookie", "fbpCookie")
# Nested columns that do not appear in the flat tables.
NESTED_COLUMNS = (
    "_id",
    "scheduledCall",
    "person",
    "partner",
    "allPaidOutBy{owner}",
    "bids",
    "estates",
    "excludeBanks",
    "internalComments",
    "loans",
    "scheduledCalls",
    "version",
    "acceptedBid",
    "adservice",
    "adtraction",
    "agentFeedback",
    "bankAccount",
    "company",
    "debtLetter",
    "lastPaidOutBy{owner}",
    "lifeInsurance",
    "loanProtectionForPartner",
    "loanProtectionForPerson",
    "loxyStatus",
    "mortgageInfo",
    "partnerTracking",
    "paymentProtection",
    "paymentStatus",
    "random",
    "status",
    "teamAttributes",
    "utm",
)
# Members whose dates are rectified.
DATE_MEMBERS = ("acceptedBid.acceptedAt", "acceptedBid.date", "paymentStatus.date", "debtLetter.date")
CLICK_IDS = {"gclid": "gclid", "fbclid": "fbclid", "snapchat_id": "scid", "microsoft_click_id": "msclkid"}


def _flat_columns(df: DataFrame, members: Mapping[str, str], owner: str, skip: Sequence[str] = ()) -> list[Column]:
    return [
        nested.member(df.schema, path.format(owner=owner)).alias(name.format(owner=owner))
        for name, path in members.items()
        if name not in skip
    ]


def _outer_columns(df: DataFrame, owner: str, also: Sequence[str] = ()) -> list[Column]:
    hidden = {c.format(owner=owner).lower() for c in NESTED_COLUMNS} | {c.lower() for c in also}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in hidden]


def applications(
    raw: DataFrame, owner: str = "Owner", brands: Brands = Brands(), tiebreak: Sequence[Column] = ()
) -> DataFrame:
    """Flat current applications with rectified dates and click ids.

    Accepted and paid dates come from the newest version where acceptance does
    not follow payment; without one, acceptance is capped at the payment date.

    Versions are made flat before they are compared, so nested columns are read member by member, and the newest
    version, the newest with rectified dates and the newest debt letter come out of one scan and one shuffle.
    """
    flat = _derived(raw, brands)
    schema = flat.schema
    accepted_at, bid_date, paid_at, letter = [nested.member(schema, path) for path in DATE_MEMBERS]
    derived = ("application_id", "versions", "updated_at", "is_status_sent")
    dates = {"__accepted": accepted_at, "__bid": bid_date, "__paid": paid_at, "__letter": letter}
    outer = [
        *_outer_columns(flat, owner, derived),
        F.col("versions"),
        F.col("updated_at"),
        *[clean.click_id(F.col("originReference"), param).alias(name) for name, param in CLICK_IDS.items()],
        F.lit(True).alias("__live"),
        *[date.alias(name) for name, date in dates.items()],
    ]
    # One value for all flat columns and one for the published members, because every value of a pick compares the orders
    # again.  A nested column that holds nothing else is taken whole: as one piece, not member by member.
    inside, published = [], []
    paths = {name.format(owner=owner): path.format(owner=owner) for name, path in MEMBERS.items()}
    read = {path.lower() for path in (*paths.values(), *DATE_MEMBERS)}
    for parent in dict.fromkeys(path.split(".")[0] for path in paths.values()):
        names = {n: p for n, p in paths.items() if p.split(".")[0] == parent}
        known = [n for n, p in names.items() if nested.has_path(schema, p)]
        whole = bool(known) and all(leaf.lower() in read for leaf in nested.leaves(schema, parent))
        if known:
            members = F.struct(*[nested.member(schema, paths[n]).alias(n) for n in known])
            inside.append((F.col(parent) if whole else members).alias(parent))
        for name, path in names.items():
            found = F.col(f"__members.{path}") if whole else F.col(f"__members.`{parent}`.`{name}`")
            published.append((found if name in known else F.lit(None).cast("string")).alias(name))
    packs = {"__outer": F.struct(*outer)} | ({"__members": F.struct(*inside)} if inside else {})
    fixed = F.struct(accepted_at.alias("accepted"), bid_date.alias("bid"), paid_at.alias("paid"))
    picks = [
        _newest(raw, tiebreak, packs),
        _newest(raw, tiebreak, {"__fixed": fixed}, accepted_at <= paid_at),
        _newest(raw, tiebreak, {"__newest_letter": letter}, letter.isNotNull()),
    ]
    docs = latest.pick_by(flat, {"application_id": F.col("_id")}, picks).filter("__outer.__live")
    own = docs.withColumns({name: F.col(f"__outer.{name}") for name in dates})
    capped = F.when(F.col("__paid").isNotNull() & (F.col("__accepted") > F.col("__paid")), F.col("__paid"))
    is_fixed = F.col("__fixed").isNotNull()
    inner = {"__live", *dates}
    return own.select(
        "application_id",
        *[F.col(f"__outer.`{c}`") for c in docs.schema["__outer"].dataType.names if c not in inner],
        *published,
        F.when(is_fixed, F.col("__fixed.accepted")).otherwise(F.coalesce(capped, "__accepted")).alias("acceptedAt"),
        F.when(is_fixed, F.col("__fixed.bid")).otherwise(F.col("__bid")).alias("acceptedBidDate"),
        F.when(is_fixed, F.col("__fixed.paid")).otherwise(F.col("__paid")).alias("paymentStatusDate"),
        F.coalesce("__letter", "__newest_letter").alias("debtLetterDate"),
    )


def all_versions(raw: DataFrame, slim: bool = False, owner: str = "Owner", brands: Brands = Brands()) -> DataFrame:
    """Every live version, flat; ``slim`` keeps six columns and drops repeats."""
    versions = live(raw)
    if slim:
        return versions.select(
            F.col("_id").alias("application_id"),
            "amount",
            "createdAt",
            F.col("updatedAt").alias("updated_at"),
            nested.member(raw.schema, "status.sent").alias("statussent"),
            "time_archived",
        ).distinct()
    derived = _derived(versions, brands)
    helpers = ("application_id", "versions", "updated_at", "is_status_sent")
    return derived.select(
        *_outer_columns(derived, owner, helpers),
        "application_id",
        "versions",
        *_flat_columns(derived, HISTORY_MEMBERS | MEMBERS, owner, skip=CURRENT_ONLY),
        *[clean.click_id(F.col("originReference"), CLICK_IDS[c]).alias(c) for c in ("gclid", "fbclid")],
    )


PARENT_COLUMNS = ("application_id", "time_archived", "versions", "updated_at", "is_status_sent")


def child_table(
    docs: DataFrame, path: str, expand: Sequence[str] = (), extra: Sequence[str] = ()
) -> DataFrame:
    """Elements of a document array with their document's keys.

    ``expand`` names struct members whose own members are published instead;
    documents without elements do not appear.
    """
    parents = [*PARENT_COLUMNS, *extra]
    items = nested.unnest(docs, path).select("item", *parents)
    if not hasattr(items.schema["item"].dataType, "fields"):
        return items
    own = [f.name for f in items.schema["item"].dataType.fields if f.name not in expand]
    inner = [
        F.col(f"item.{struct}.{f.name}").alias(f.name)
        for struct in expand
        for f in nested.type_at(items.schema, f"item.{struct}").fields
    ]
    return items.select(*[F.col(f"item.`{c}`").alias(c) for c in own], *inner, *parents)


# Person members published with an applicant.
PERSON_MEMBERS = (
    "first_name",
    "last_name",
    "age",
    "citizenship",
    "postalArea",
    "address",
    "occupation",
    "civilStatus",
    "education",
    "email",
    "idNumber",
    "employerPhone",
    "employer",
    "phoneNumber",
    "militaryService",
    "employedSince",
    "employedUntil",
    "workStatus",
    "workStatusSince",
    "livingCost",
    "rent",
    "homeStatus",
    "homeSince",
    "monthlyIncome",
    "monthlyNetIncome",
    "spouseIncome",
    "politicallyExposedPerson",
    "postalCode",
    "gender",
    "children",
    "hasacceptedcreditreport",
    "jojkaBlocklist",
    "extraIncome",
)
BANK_MEMBERS = ("accountNumber", "yearsWithBank", "sinceYear", "clearingNumber", "bankName")
COMPANY_MEMBERS = {
    "business_organization_number": "company.organizationNumber",
    "employment_industry_text": "company.industryType",
    "business_registration_date": "company.foundationDate",
}


def _either(docs: DataFrame, side, keep_partner: Column | None = None) -> Column:
    """Person and partner as an array, so both come out of one scan."""
    partner = side("partner")
    if keep_partner is not None:
        partner = F.when(F.coalesce(keep_partner, F.lit(False)), partner)
    return F.filter(F.array(side("person"), partner), lambda p: p.isNotNull())


def applicants(docs: DataFrame) -> DataFrame:
    """One row per applicant: the person, and the partner of joint applications."""
    schema = docs.schema

    def side(role: str) -> Column:
        fallback = F.coalesce(nested.member(schema, f"{role}._id"), nested.member(schema, f"{role}.idNumber"))
        return F.struct(
            F.concat(F.col("_id"), F.lit("|"), fallback).alias("application_applicant_id"),
            nested.member(schema, f"{role}._id").alias("applicant_id"),
            *[nested.member(schema, f"{role}.{m}").alias(m) for m in PERSON_MEMBERS],
            F.lit(role).alias("applicant_type"),
        )

    rows = docs.withColumn("p", F.explode(_either(docs, side, F.col("has_co_applicant"))))
    return rows.select(
        "is_status_sent",
        "time_archived",
        "versions",
        "updated_at",
        "p.application_applicant_id",
        "createdAt",
        F.col("createdAt").alias("valid_from"),
        "p.applicant_id",
        *[F.col(f"p.{m}") for m in PERSON_MEMBERS],
        "p.applicant_type",
        *[nested.member(schema, path).alias(name) for name, path in COMPANY_MEMBERS.items()],
        nested.member(schema, "islead").alias("islead"),
        nested.member(schema, "market").alias("market"),
        "brand",
        *[nested.member(schema, f"bankAccount.{m}").alias(m) for m in BANK_MEMBERS],
    )


# Credit report members and their published names.
REPORT_COLUMNS = {
    "_id": "_id",
    "type": "type",
    "createdAt": "createdAt",
    "taxableIncomeYear": "taxableIncomeYear",
    "taxableIncome": "taxableIncome",
    "creditScore": "creditScore",
    "registeredAt": "registeredAt",
    "ucRegisteredAt": "ucRegisteredAt",
    "numberOfRecords": "numberOfRecords",
    "capitalDeficit": "capitalDeficit",
    "ucBlockCode": "ucBlockCode",
    "lastYeartaxableIncome": "lastYearTaxInfo.taxableIncome",
    "lastYearcapitalDeficit": "lastYearTaxInfo.capitalDeficit",
    "lastYeartaxableIncomeYear": "lastYearTaxInfo.taxableIncomeYear",
    "latest_record_type": "latestRecordDetails.type",
    "claimant": "latestRecordDetails.claimant",
    "latestRecordDetails_date": "latestRecordDetails.date",
    "amount": "latestRecordDetails.amount",
    "hasdebtreconstruction": "currentdebt.hasdebtreconstruction",
    "hasDebtBalance": "currentdebt.hasDebtBalance",
}


def _reports(docs: DataFrame) -> DataFrame:
    """Reports of person and partner, gated by nothing but their presence."""

    def side(role: str) -> Column:
        return F.struct(
            F.concat(F.col("_id"), F.lit("|"), F.col(f"{role}._id")).alias("customer_id"),
            F.col(f"{role}.idNumber").alias("idNumber"),
            F.col(f"{role}.creditReports").alias("reports"),
        )

    people = docs.withColumn("p", F.explode(_either(docs, side)))
    return people.withColumn("cr", F.explode("p.reports"))


def credit_reports(docs: DataFrame) -> DataFrame:
    """One row per credit report of a person or partner."""
    rows = _reports(docs)
    return rows.select(
        "is_status_sent",
        "p.customer_id",
        "p.idNumber",
        nested.member(docs.schema, "market").alias("market"),
        F.concat(F.col("_id"), F.lit("|"), F.col("cr._id")).alias("credit_report_id"),
        *[nested.member(rows.schema, f"cr.{path}").alias(name) for name, path in REPORT_COLUMNS.items()],
        "time_archived",
        "versions",
        "updated_at",
        "application_id",
        F.col("createdAt").alias("application_created_at"),
    )


def past_requests(docs: DataFrame) -> DataFrame:
    """One row per past request inside the credit reports."""
    rows = _reports(docs).select(
        F.concat(F.col("_id"), F.lit("|"), F.col("cr._id")).alias("credit_report_id"),
        "time_archived",
        "versions",
        "updated_at",
        "is_status_sent",
        F.explode("cr.pastReportRequests").alias("r"),
    )
    return rows.select(
        *[c for c in rows.columns if c != "r"],
        F.col("r.name").alias("past_report_requests_name"),
        F.col("r.date").alias("past_report_requests_date"),
        F.col("r._id").alias("past_report_requests_id"),
    )


def invitations(invites: DataFrame, docs: DataFrame) -> DataFrame:
    """Live invitations with the brand of their application."""
    brand_of = docs.select(F.col("_id").alias("__application"), "brand")
    rows = lookup_join(live(invites), brand_of, [(F.col("application"), "__application")])
    renamed = rows.withColumnRenamed("_id", "invite_id").withColumnRenamed("__v", "versions")
    others = [c for c in renamed.columns if c not in ("invite_id", "versions")]
    return renamed.select(*others, "invite_id", "versions")


def passthrough(raw: DataFrame) -> DataFrame:
    """Live rows as they are."""
    return live(raw)


def unsubscriptions(raw: DataFrame, before: str = UNSUBSCRIBED_BEFORE, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Newest live version of the backlog created before a date."""
    backlog = live(raw).filter(F.to_date("createdAt") < F.lit(before).cast("date"))
    return latest.latest_by(backlog, ["_id"], [F.col("__v").desc(), F.col("time_archived").desc()], tiebreak)
