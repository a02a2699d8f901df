"""Scalar rules as built-in column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_text(c: ColumnLike, field: str) -> Column:
    """Text of a top-level JSON field, NULL when the document is malformed."""
    return F.get_json_object(as_col(c), f"$.{field}")


# ---- text and nulls -------------------------------------------------------------------------


def non_blank(c: ColumnLike) -> Column:
    """The value itself, or NULL when it is empty or only spaces."""
    c = as_col(c)
    return F.when(F.trim(c) != "", c)


def first_non_blank(*cols: ColumnLike) -> Column:
    return F.coalesce(*[non_blank(c) for c in cols])


# Whitespace that makes a name need rewriting.
_UNEVEN = ("  ", "\t", "\n", "\r", "\f", "\v")


def normalize_event(c: ColumnLike) -> Column:
    """Collapse runs of whitespace and trim; the regular expression only runs where it is needed."""
    c = as_col(c)
    uneven = reduce(lambda a, b: a | b, [c.contains(w) for w in _UNEVEN])
    return F.when(uneven, F.trim(F.regexp_replace(c, r"\s+", " "))).otherwise(F.trim(c))


def clean_offer_id(c: ColumnLike) -> Column:
    """Offer id without quotes and surrounding spaces."""
    return F.trim(F.translate(as_col(c), "\"'", ""))


def resolve_company_id(
    workflow: ColumnLike = "workflow_state",
    widget: ColumnLike = "widget_state",
    *fallbacks: ColumnLike,
) -> Column:
    """Company id from the workflow document, then the widget document, then plain columns."""
    plain = [as_col(c) for c in (fallbacks or ("company_id",))]
    embedded = [json_text(doc, "client_realm_id") for doc in (workflow, widget)]
    return F.coalesce(first_non_blank(*embedded), *plain)


def resolve_product(
    product: ColumnLike = "product",
    workflow: ColumnLike = "workflow_state",
    widget: ColumnLike = "widget_state",
) -> Column:
    return F.coalesce(as_col(product), json_text(workflow, "product"), json_text(widget, "product"))


def numeric_id(c: ColumnLike) -> Column:
    """Text id as bigint; text that is no number becomes NULL instead of failing the job."""
    return as_col(c).try_cast("bigint")


# ---- flags ----------------------------------------------------------------------------------


def yes_no(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def flag_to_yes_no(c: ColumnLike) -> Column:
    return yes_no(as_col(c) == 1)


def accountant_flag(c: ColumnLike) -> Column:
    return yes_no(non_blank(c).isNotNull())


def eligible(
    country: ColumnLike, accountant: ColumnLike, suspicious: ColumnLike, home: str = "United States"
) -> Column:
    """Home-country companies, or any country when an accountant started it; never suspicious."""
    return ((as_col(country) == home) | (as_col(accountant) == "Y")) & (as_col(suspicious) == 0)


def baked(day: ColumnLike, days: int, as_of: Column) -> Column:
    """1 once ``days`` full days have passed before ``as_of`` (strictly)."""
    return flag(F.date_add(as_col(day), days) < as_of)


# ---- classification -------------------------------------------------------------------------

# Device types counted as mobile.
MOBILE_DEVICES = ("mobile", "tablet", "smartphone", "phone")


def classify_screen(
    host: ColumnLike, device: ColumnLike, path: ColumnLike, extended: bool = False
) -> Column:
    """Surface on which a flow started; the first matching class wins.

    ``extended`` adds the two looser host and path rules of the SQL variant.
    """
    host, device, path = (F.lower(as_col(c)) for c in (host, device, path))
    portal = [host.contains("accounts."), path.contains("accountmanager")]
    mobile = [device.isin(*MOBILE_DEVICES), host.contains("mobile")]
    web = [host.contains("app."), host.contains("saas.")]
    if extended:
        portal.append(path.contains("accounts."))
        web.append(host.contains("dashboard"))
    any_of = lambda tests: reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests])
    return (
        F.when(any_of(portal), "Account Portal")
        .when(any_of(mobile), "SaaS Mobile App")
        .when(any_of(web), "SaaS Web App")
        .otherwise("Unknown")
    )


def classify_offer(
    cta_action: Column, primary_action: Column, url: Column, discount_id: Column
) -> Column:
    """Offer class from its call-to-action; the first matching class wins."""
    external = primary_action == "external"
    return (
        F.when(F.coalesce(cta_action, primary_action) == "contact-us-widget", "CS IPD")
        .when(discount_id.isNotNull(), "Discount IPD")
        .when(external & url.contains("/obillupgrade"), "Upgrade IPD")
        .when(external & url.contains("/changeplan"), "Downgrade IPD")
        .when(primary_action == "callbackOnly", "Keep my Plan IPD")
        .otherwise("Unknown")
    )


def classify_offer_copy(copy: ColumnLike) -> Column:
    """``classify_offer`` over a JSON offer description."""
    return classify_offer(
        json_text(copy, "ctaAction"),
        json_text(copy, "primaryCtaAction"),
        json_text(copy, "primaryCtaUrl"),
        json_text(copy, "obillOfferId"),
    )


def attribution(
    cs: ColumnLike,
    confirmed: ColumnLike,
    upgraded: ColumnLike,
    downgraded: ColumnLike,
    discount: ColumnLike,
) -> Column:
    """Outcome of an episode by descending priority."""
    ladder = [
        ("CS Save", cs),
        ("Cancelled", confirmed),
        ("Upgrade Save", upgraded),
        ("Downgrade Save", downgraded),
        ("Discount Save", discount),
    ]
    return F.coalesce(
        *[F.when(as_col(c) == 1, F.lit(label)) for label, c in ladder], F.lit("Abandoned")
    )


def abandoned_without_help(
    cs: ColumnLike,
    confirmed: ColumnLike,
    upgraded: ColumnLike,
    downgraded: ColumnLike,
    discount: ColumnLike,
) -> Column:
    """Y when nothing saved the company and it did not cancel either."""
    active = [F.coalesce(as_col(c), F.lit(0)) for c in (cs, confirmed, upgraded, downgraded, discount)]
    return yes_no(F.greatest(*active) == 0)


def risk_tier(score: ColumnLike) -> Column:
    score = as_col(score)
    return (
        F.when(score >= 0.75, "CRITICAL")
        .when(score >= 0.55, "HIGH")
        .when(score >= 0.35, "MEDIUM")
        .otherwise("LOW")
    )


# Labels of the tenure cohorts.
TENURE_LABELS = ("0-90d (Early Life)", "91-365d (Mid Life)", "365d+ (Mature)")


def tenure_bucket(days: ColumnLike, labels: tuple = (1, 2, 3)) -> Column:
    days = as_col(days)
    early, mid, mature = (F.lit(v) for v in labels)
    return F.when(days < 90, early).when(days < 365, mid).otherwise(mature)


# ---- numbers and dates ----------------------------------------------------------------------


def safe_divide(numerator: ColumnLike, denominator: ColumnLike, default: float = 0.0) -> Column:
    """Quotient, or ``default`` when the denominator is zero or NULL."""
    n, d = as_col(numerator).cast("double"), as_col(denominator).cast("double")
    return F.when(d.isNull() | (d == 0), F.lit(float(default))).otherwise(F.try_divide(n, d))


def percent(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Rounded percentage, NULL when the denominator is zero."""
    return F.round(F.try_divide(numerator.cast("double") * 100.0, denominator), digits)


def partition_year(day: ColumnLike) -> Column:
    return F.date_format(as_col(day), "yyyy")


def partition_month(day: ColumnLike) -> Column:
    return F.date_format(as_col(day), "MM")


def with_partition_keys(df: DataFrame, day: str) -> DataFrame:
    return df.withColumns(
        {"initiation_year": partition_year(day), "initiation_month": partition_month(day)}
    )


def with_audit(df: DataFrame, now: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if now is None else now
    return df.withColumns({"dwh_create_date": now, "dwh_update_date": now})


def mask_pii(df: DataFrame, rules: dict[str, str], salt: str = "") -> DataFrame:
    """Mask columns in place: ``hash`` keeps joinability, ``mask`` keeps the shape, ``drop`` nulls."""
    builders = {
        "hash": lambda c: F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256),
        "mask": lambda c: F.mask(F.col(c).cast("string")),
        "drop": lambda c: F.lit(None).cast(df.schema[c].dataType),
    }
    unknown = set(rules.values()) - builders.keys()
    if unknown:
        raise ValueError(f"unknown masking modes: {sorted(unknown)}")
    return df.withColumns({c: builders[mode](c) for c, mode in rules.items()})
