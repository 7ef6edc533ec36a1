"""Period literals, periodicities and dates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubagem.functions.literals import constant_array, constant_rows

# The month names used in period literals.
MONTHS = [
    "janeiro",
    "fevereiro",
    "março",
    "abril",
    "maio",
    "junho",
    "julho",
    "agosto",
    "setembro",
    "outubro",
    "novembro",
    "dezembro",
]

# Canonical frequencies.
ROLLING_QUARTER = "trimestre_movel"
MONTHLY = "mensal"
QUARTERLY = "trimestral"
HALF_YEARLY = "semestral"
YEARLY = "anual"
MULTI_YEAR = "plurianual"
UNRECOGNISED = "nao_reconhecida"

# The frequencies that periods of a cube of a given periodicity may have.
PERIODICITY_FREQUENCIES = {
    "mensal": [MONTHLY],
    "trimestral": [QUARTERLY],
    "trimestral móvel": [ROLLING_QUARTER],
    "semestral": [HALF_YEARLY],
    "anual": [YEARLY, MULTI_YEAR],
    "decenal": [YEARLY, MULTI_YEAR],
}


def rolling_label(month: int) -> str:
    """``jan-fev-mar`` for 1, ``dez-jan-fev`` for 12."""
    return "-".join(MONTHS[(month - 1 + step) % 12][:3] for step in range(3))


# One entry per label that can stand before a year: (label, frequency, first month,
# months, month, quarter, half-year).
_LABELS = [
    *[(rolling_label(m), ROLLING_QUARTER, m, 3, (m + 1) % 12 + 1, None, None) for m in range(1, 13)],
    *[(name, MONTHLY, m, 1, m, None, None) for m, name in enumerate(MONTHS, start=1)],
    *[(f"{q}º trimestre", QUARTERLY, 3 * q - 2, 3, None, q, None) for q in range(1, 5)],
    *[(f"{s}º semestre", HALF_YEARLY, 6 * s - 5, 6, None, None, s) for s in range(1, 3)],
]

# A label may be followed by either of these before the year.
_SEPARATORS = [" de ", " "]
_PREFIXES = [entry[0] + separator for separator in _SEPARATORS for entry in _LABELS]

# A year from 0001, and a line end that may follow it.
_YEAR = r"((?!0000)\d{4})"
_END = r"\n?\z"
_LABELLED = rf"(?s)^(.+){_YEAR}{_END}"
_YEARS = rf"^{_YEAR}(?:/{_YEAR})?{_END}"

# i: ignore case, u: also for accented letters, d: only \n ends a line.
_LOOKS_LIKE_PERIOD = (
    r"(?iud)^(?:(?:\dº (?:trimestre|semestre)|"
    + "|".join(entry[0] for entry in _LABELS if not entry[0][0].isdigit())
    + r")(?: de | )\d{4}|\d{4}(?:/\d{4})?)$"
)


def _label_entry(position: Column) -> Column:
    """The label's frequency, first month, months, month, quarter and half-year."""
    rows = [entry[1:] for entry in _LABELS] * len(_SEPARATORS)
    fields = "frequencia string, inicio int, meses int, mes int, trimestre int, semestre int"
    return F.get(constant_rows(rows, fields), position - 1)


def parse_periods(df: DataFrame, literals: str = "literals", strict: bool = False) -> DataFrame:
    """Add frequency, date range and date parts read from ``literals[0]``.

    The frequency is one of the canonical names; a literal of no known form gets
    ``nao_reconhecida`` and nulls. So does a well-formed but impossible one, such
    as a fifth quarter or the year 0000; ``strict`` makes those an error.
    """
    literal = F.get(F.col(literals), F.lit(0))

    # A text is matched once with each pattern: four digits follow the label, and a slash and four digits the year.
    label, first = F.col("_text"), F.col("_years")
    prefixes = constant_array(_PREFIXES, "string")
    read = (
        df.withColumn("_text", F.regexp_extract(literal, _LABELLED, 1))
        .withColumn("_label", F.array_position(prefixes, F.lower(label)))
        # Labels have letters, so what begins with one is not made of years.
        .withColumn("_years", F.when(F.col("_label") > 0, "").otherwise(F.regexp_extract(literal, _YEARS, 1)))
        .withColumns(
            {
                "_entry": _label_entry(F.col("_label").cast("int")),
                "_first": first.try_cast("int"),
                "_to": F.when(first != "", F.substring(literal, 6, 4)).try_cast("int"),
            }
        )
        .withColumn(
            "_from",
            F.when(F.col("_label") > 0, F.substring(literal, F.length(label) + 1, F.lit(4)).try_cast("int")).otherwise(
                F.col("_first")
            ),
        )
        .drop("_text", "_years")
    )
    entry, year, year_end = F.col("_entry"), F.col("_from"), F.col("_to")
    fallback = F.lit(UNRECOGNISED)
    if strict:
        impossible = F.coalesce(literal.rlike(_LOOKS_LIKE_PERIOD), F.lit(False))
        message = F.concat(F.lit("impossible period: "), literal)
        fallback = F.when(impossible, F.raise_error(message)).otherwise(fallback)
    return (
        read.withColumns(
            {
                "frequencia": F.coalesce(
                    entry["frequencia"],
                    F.when(year_end != F.col("_first"), F.lit(MULTI_YEAR)),
                    F.when(F.col("_first").isNotNull(), F.lit(YEARLY)),
                    fallback,
                ),
                "data_inicio": F.make_date(
                    year, F.coalesce(entry["inicio"], F.lit(1)), F.lit(1)
                ),
                "ano": year,
                "mes": entry["mes"],
                "trimestre": entry["trimestre"],
                "semestre": entry["semestre"],
                "ano_fim": F.when(year_end != year, year_end),
            }
        )
        .withColumn(
            "data_fim",
            F.coalesce(
                month_range_end(F.col("data_inicio"), entry["meses"]),
                F.make_date(F.coalesce(year_end, year), F.lit(12), F.lit(31)),
            ),
        )
        .drop("_label", "_first", "_to", "_entry", "_from")
    )


def month_range_end(start: Column, months: Column | int) -> Column:
    """Last day of the ``months`` months that begin on ``start``."""
    return F.date_sub(F.add_months(start, months), 1)


def expected_frequencies(periodicity: Column) -> Column:
    """Frequencies allowed for a periodicity; an empty array means no restriction."""
    table = F.create_map(
        *[
            item
            for name, allowed in PERIODICITY_FREQUENCIES.items()
            for item in (F.lit(name), constant_array(allowed, "string"))
        ]
    )
    key = F.lower(F.regexp_replace(periodicity, r"(?U)^\s+|\s+$", ""))
    none = F.array().cast("array<string>")
    return F.coalesce(F.try_element_at(table, key), none)


def conforms(periodicity: Column, frequency: Column) -> Column:
    """Whether a period of this frequency may belong to a cube of this periodicity."""
    allowed = expected_frequencies(periodicity)
    return (F.size(allowed) == 0) | F.coalesce(F.array_contains(allowed, frequency), F.lit(False))


def conforming_periods(
    df: DataFrame, periodicity: str = "periodicidade", frequency: str = "frequencia"
) -> DataFrame:
    """Keep the periods whose frequency fits the periodicity of their cube."""
    return df.where(conforms(F.col(periodicity), F.col(frequency)))


def parse_date(text: Column, strict: bool = False) -> Column:
    """``d/m/yyyy`` if the text has a slash, else an ISO calendar or week date."""
    week = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?$"

    def iso(value: Column) -> Column:
        def part(group: int) -> Column:
            return F.regexp_extract(value, week, group).try_cast("int")

        week_monday = F.date_trunc("week", F.make_date(part(1), F.lit(1), F.lit(4))).cast("date")
        week_date = F.date_add(
            week_monday, (part(2) - 1) * 7 + F.coalesce(part(3), F.lit(1)) - 1
        )
        return (
            F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(value, "yyyy-MM-dd"))
            .when(value.rlike(r"^\d{8}$"), F.try_to_date(value, "yyyyMMdd"))
            .when(value.rlike(week) & (F.weekofyear(week_date) == part(2)), week_date)
        )

    # A lambda ends the method that Spark makes of a row's columns; the JVM compiles none beyond 8,000 bytes.
    others = F.get(F.transform(F.array(text), iso), F.lit(0))
    parsed = F.when(text.contains("/"), F.try_to_date(text, "d/M/yyyy")).otherwise(others)
    if not strict:
        return parsed
    bad = text.isNotNull() & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a date: "), text))).otherwise(parsed)
