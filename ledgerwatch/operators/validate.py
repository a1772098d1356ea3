"""Row validation: every rule is a column expression, all errors of a row form one array.

A rule yields ``struct<code, field, severity, message>`` or NULL; the array keeps
the fired ones.  The struct is a constant per rule (values stay in the row, out
of the messages), which keeps the generated code small.  The rules read fields through ``Field`` (present? null? text?
kind of value?), so the same rules serve raw JSON messages, where a missing key
differs from a null, and typed tables.
"""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch import schema
from ledgerwatch.config import QualityConfig
from ledgerwatch.functions.times import as_instant, hours, moment

ERRORS = "array<struct<code:string,field:string,severity:string,message:string>>"

# Fields, types and patterns of the two contracts.
TRANSACTION_REQUIRED = [
    "transaction_id", "timestamp", "customer_id", "amount", "currency", "merchant_id", "status",
]
TRANSACTION_KINDS = {
    "transaction_id": {"TEXT"},
    "timestamp": {"INTEGER", "TEXT"},
    "customer_id": {"TEXT"},
    "amount": {"TEXT", "NUMBER"},
    "currency": {"TEXT"},
    "merchant_id": {"TEXT"},
    "status": {"TEXT"},
}
TRANSACTION_PATTERNS = {
    "transaction_id": "^[a-f0-9-]{36}$",
    "currency": "^[A-Z]{3}$",
}
TWO_DECIMAL_CURRENCIES = ["USD", "EUR", "GBP", "CAD"]
WHOLE_CURRENCIES = ["JPY"]
ALERT_REQUIRED = [
    "alert_id", "transaction_id", "customer_id_hash", "alert_type", "severity", "risk_score",
]
INTEGRITY_FIELDS = [
    "transaction_id", "timestamp", "customer_id", "amount", "merchant_id", "status",
]


@dataclass(frozen=True)
class Field:
    """How the rules see one field of a row."""

    name: str
    present: Column  # the key exists
    text: Column     # value as text, NULL when null
    kind: Column     # TEXT, INTEGER, NUMBER or OTHER
    number: Column   # value as a number, NULL when it is none
    instant: Column  # value as a time, NULL when it is none

    @property
    def filled(self):
        return self.present & self.text.isNotNull()


VIEW = "_view_"
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def as_number(text):
    """Exact number from decimal text; NULL for anything else, as NaN, type suffixes or overflow."""
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("decimal(38,10)"))


def _views(df, columns, names):
    """Add text, kind and presence of each field as columns, and the fields over them.

    The rules mention a field many times; as columns of an inner projection its
    value is computed once per row.
    """
    added = df.withColumns({f"{VIEW}{k}": c for k, c in columns.items()})
    part = lambda n, what: F.col(f"{VIEW}{n}_{what}")
    read = {}
    for n in names:
        if f"{n}_number" not in columns:
            read[f"{VIEW}{n}_number"] = as_number(part(n, "text"))
        if f"{n}_instant" not in columns:
            read[f"{VIEW}{n}_instant"] = as_instant(part(n, "text"))
    # unused ones are pruned
    return added.withColumns(read), {
        n: Field(n, *[part(n, w) for w in ("present", "text", "kind", "number", "instant")])
        for n in names
    }


def view_json(df, raw, names):
    """Field views of a JSON text column."""
    # One parse of the named keys only.  An absent key gives NULL, a null value a variant null.
    wanted = ", ".join(f"`{n}` variant" for n in names)
    doc = df.withColumn(f"{VIEW}doc", F.from_json(F.col(raw).cast("string"), wanted))
    value = {n: F.col(f"{VIEW}doc.{n}") for n in names}
    doc = doc.withColumns({f"{VIEW}{n}_type": F.schema_of_variant(value[n]) for n in names})
    columns = {}
    for n in names:
        t = F.col(f"{VIEW}{n}_type")
        columns[f"{n}_present"] = t.isNotNull()
        columns[f"{n}_text"] = F.try_variant_get(value[n], "$", "string")
        columns[f"{n}_kind"] = (
            F.when(t == "STRING", "TEXT").when(t == "BIGINT", "INTEGER")
            .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "NUMBER")
            .otherwise("OTHER")
        )
    return _views(doc, columns, names)


def view_columns(df, names):
    """Field views of typed columns; an absent column is a missing field."""
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = {}
    for n in names:
        t = types.get(n)
        if isinstance(t, (T.StringType, T.TimestampType, T.TimestampNTZType, T.DateType)):
            kind = "TEXT"
        elif isinstance(t, (T.IntegralType, T.BooleanType)):
            kind = "INTEGER"
        else:
            kind = "NUMBER" if isinstance(t, (T.FractionalType, T.DecimalType)) else "OTHER"
        columns[f"{n}_present"] = F.lit(n in types)
        columns[f"{n}_text"] = (F.col(n) if n in types else F.lit(None)).cast("string")
        columns[f"{n}_kind"] = F.lit(kind)
        if isinstance(t, T.NumericType):
            exact = isinstance(t, (T.DecimalType, T.IntegralType))
            columns[f"{n}_number"] = F.col(n).cast("decimal(38,10)" if exact else "double")
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            columns[f"{n}_instant"] = F.col(n).cast("timestamp")
    return _views(df, columns, names)


def _error(condition, code, field, severity, message):
    return F.when(
        condition,
        F.struct(
            F.lit(code).alias("code"), F.lit(field).alias("field"),
            F.lit(severity).alias("severity"), F.lit(message).alias("message"),
        ),
    )


def required_rules(fields, names):
    for name in names:
        f = fields[name]
        yield _error(~f.present, "REQUIRED_MISSING", name, "CRITICAL",
                     f"Missing required field: {name}")
        yield _error(f.present & f.text.isNull(), "REQUIRED_NULL", name, "CRITICAL",
                     f"Required field is null: {name}")
        yield _error(f.filled & (f.kind == "TEXT") & (F.trim(f.text) == ""),
                     "REQUIRED_EMPTY", name, "CRITICAL",
                     f"Required field is empty: {name}")


def type_rules(fields, kinds):
    for name, allowed in kinds.items():
        f = fields[name]
        yield _error(f.filled & ~f.kind.isin(sorted(allowed)), "WRONG_TYPE", name, "ERROR",
                     f"Wrong type: {name} must be {' or '.join(sorted(allowed))}")


def range_rules(fields, ranges, severity="ERROR"):
    for name, (low, high) in ranges.items():
        f = fields[name]
        outside = (f.number < low) | (f.number > high)
        yield _error(f.filled & f.number.isNull(), "NOT_NUMERIC", name, severity,
                     f"Not a number: {name}")
        yield _error(f.filled & outside, "OUT_OF_RANGE", name, severity,
                     f"Outside [{low}, {high}]: {name}")


def allowed_rules(fields, lists):
    for name, values in lists.items():
        f = fields[name]
        yield _error(f.filled & ~f.text.isin(list(values)), "NOT_ALLOWED", name, "ERROR",
                     f"Value not allowed: {name}")


def pattern_rules(fields, patterns):
    for name, pattern in patterns.items():
        f = fields[name]
        # (?d): only \n ends a line, so one trailing newline is accepted and nothing else
        yield _error(f.filled & ~f.text.rlike(f"(?d){pattern}"), "PATTERN_MISMATCH", name,
                     "ERROR", f"Pattern mismatch: {name}")


def amount_rules(fields, cfg):
    f = fields["amount"]
    yield _error(f.present & f.number.isNull(), "AMOUNT_FORMAT", "amount", "CRITICAL",
                 "Unreadable amount")
    yield _error(f.number > cfg.business_max_amount, "AMOUNT_ABOVE_MAX", "amount", "ERROR",
                 f"Amount above {cfg.business_max_amount}")
    yield _error(f.number < cfg.business_min_amount, "AMOUNT_BELOW_MIN", "amount", "ERROR",
                 f"Amount below {cfg.business_min_amount}")


def timestamp_rules(fields, cfg, as_of):
    f = fields["timestamp"]
    yield _error(f.present & f.instant.isNull(), "TIMESTAMP_FORMAT", "timestamp", "ERROR",
                 "Unreadable timestamp")
    yield _error(f.instant > moment(as_of) + hours(cfg.future_tolerance_hours),
                 "TIMESTAMP_FUTURE", "timestamp", "CRITICAL",
                 "Timestamp too far in the future")


def currency_rules(fields):
    amount, currency = fields["amount"].number, fields["currency"].text
    fraction = (currency.isin(WHOLE_CURRENCIES) & (amount != F.round(amount, 0))) | (
        currency.isin(TWO_DECIMAL_CURRENCIES) & (amount != F.round(amount, 2)))
    yield _error(fraction, "CURRENCY_DECIMALS", "amount", "ERROR",
                 "Too many decimals for the currency")


def transaction_rules(fields, cfg, as_of):
    yield from required_rules(fields, TRANSACTION_REQUIRED)
    yield from type_rules(fields, TRANSACTION_KINDS)
    yield from range_rules(
        fields, {"amount": (cfg.range_min_amount, cfg.range_max_amount)}, "CRITICAL")
    yield from allowed_rules(fields, {"currency": cfg.currencies, "status": cfg.statuses})
    yield from pattern_rules(fields, TRANSACTION_PATTERNS)
    yield from amount_rules(fields, cfg)
    yield from timestamp_rules(fields, cfg, as_of)
    yield from currency_rules(fields)


def alert_rules(fields):
    yield from required_rules(fields, ALERT_REQUIRED)
    yield from range_rules(fields, {"risk_score": (0.0, 1.0), "confidence_score": (0.0, 1.0)})
    yield from allowed_rules(fields, {"severity": schema.SEVERITIES})


def with_errors(viewed, rules):
    """Add ``errors``, ``is_valid`` and ``has_critical``; drop the field views."""
    checked = viewed.withColumn("errors", F.array_compact(F.array(*rules)).cast(ERRORS))
    return checked.withColumns({
        "is_valid": F.size("errors") == 0,
        "has_critical": F.exists("errors", lambda e: e["severity"] == "CRITICAL"),
    }).drop(*[c for c in checked.columns if c.startswith(VIEW)])


def validate_messages(df, raw="value", cfg=QualityConfig(), as_of=None):
    """All transaction rules over a JSON text column."""
    viewed, fields = view_json(df, raw, TRANSACTION_REQUIRED)
    return with_errors(viewed, transaction_rules(fields, cfg, as_of))


def validate_transactions(df, cfg=QualityConfig(), as_of=None):
    """All transaction rules over typed columns."""
    viewed, fields = view_columns(df, TRANSACTION_REQUIRED)
    return with_errors(viewed, transaction_rules(fields, cfg, as_of))


def validate_alerts(df):
    viewed, fields = view_columns(df, [*ALERT_REQUIRED, "confidence_score"])
    return with_errors(viewed, alert_rules(fields))


def each_error(validated, *keep):
    """One row per error, with the kept columns."""
    # explode_outer: plain explode makes the optimizer repeat the whole rule array in a filter
    return (
        validated.select(*keep, F.explode_outer("errors").alias("_e"))
        .filter(F.col("_e").isNotNull()).select(*keep, "_e.*")
    )


def integrity_holds(df):
    """True where the six fields every consumer relies on are filled."""
    holds = F.lit(True)
    for name in INTEGRITY_FIELDS:
        holds = holds & (F.col(name).isNotNull() if name in df.columns else F.lit(False))
    return holds


def split_valid(validated, reference="transaction_id"):
    """(valid rows, invalid rows as reference + errors + flags)."""
    valid = validated.filter("is_valid").drop("errors", "is_valid", "has_critical")
    invalid = validated.filter("not is_valid").select(reference, "errors", "has_critical")
    return valid, invalid


def daily_totals(df, customer="customer_id", ts="timestamp"):
    """Amount per customer and day; summed map-side first, so a hot customer is no bottleneck."""
    return df.groupBy(customer, F.to_date(ts).alias("day")).agg(
        F.sum("amount").alias("daily_amount"), F.count("*").alias("daily_rows")
    )


def daily_limit_breaches(df, cfg=QualityConfig(), customer="customer_id", ts="timestamp"):
    """Customer-days above the daily amount limit."""
    limit = F.lit(cfg.daily_max_per_customer).cast("decimal(12,2)")
    return daily_totals(df, customer, ts).filter(
        F.col(customer).isNotNull() & (F.col("daily_amount") > limit)
    )


def flag_daily_limit(df, cfg=QualityConfig(), customer="customer_id", ts="timestamp"):
    """``exceeds_daily_limit`` per row, by joining the few breaching customer-days.

    No window over the customer: AQE may broadcast the breaches or split a
    skewed partition of the rows.
    """
    breaches = daily_limit_breaches(df, cfg, customer, ts).select(
        customer, "day", F.lit(True).alias("_breach")
    )
    return (
        df.withColumn("day", F.to_date(ts))
        .join(breaches, [customer, "day"], "left")
        .withColumn("exceeds_daily_limit", F.coalesce("_breach", F.lit(False)))
        .drop("_breach", "day")
    )
