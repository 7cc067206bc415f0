"""Validation rules of rows and the long-form table of their violations.

A rule is a condition, the text that explains a violation and a severity. A row's violations come from
one pass: an array of the rules that fire, exploded. Texts are built for violating rows alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import any_of, names_where, number_text, says, to_day, to_number
from .no_activity import EPSILON

ERROR, WARNING = "ERROR", "WARNING"


@dataclass(frozen=True)
class Check:
    rule: str
    violated: Column
    detail: Column
    delta: Column | None = None
    severity: str = ERROR


def annotate(df: DataFrame, checks: list[Check], flag: str) -> DataFrame:
    """df plus a flag: whether no check is violated."""
    return df.withColumn(flag, ~any_of([F.coalesce(c.violated, F.lit(False)) for c in checks]))


def anomalies(df: DataFrame, checks: list[Check], keep: list[str], with_delta: bool = False) -> DataFrame:
    """A row for each violated check: the columns of keep, Rule, Detail, (Delta,) Severity. Columns that df lacks are empty text."""
    kept = [F.col(f"`{c}`") if c in df.columns else F.lit("").alias(c) for c in keep]
    items = [
        F.when(F.coalesce(c.violated, F.lit(False)), F.struct(F.lit(c.rule).alias("Rule"), c.detail.alias("Detail"), (c.delta if c.delta is not None else F.lit(None)).cast("double").alias("Delta"), F.lit(c.severity).alias("Severity")))
        for c in checks
    ]
    hits = df.select(*kept, F.explode(F.array_compact(F.array(*items))).alias("hit"))
    return hits.select(*[F.col(f"`{c}`") for c in keep], "hit.Rule", "hit.Detail", *(["hit.Delta"] if with_delta else []), "hit.Severity")


def raw_text(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.concat(F.lit("'"), F.col(f"`{name}`").cast("string"), F.lit("'")), F.lit("None"))


# ---- transactions ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class TransactionColumns:
    reference: str = "ReferenceTransaction"
    bank: str = "RefBanque"
    when: str = "DateTransaction"
    created: str = "dtCr"
    amount: str = "MontantTransaction"
    rate: str = "TauxDeChange"
    country: str = "Pays"
    country_idle: str = "NoAs"
    template: tuple[str, ...] = ("TypeSwfit", "ModeReglement", "Devise", "NomDonneurOrdre", "NifNni", "SourceDevise", "Beneficiaire", "Produit", "NatureEconomique")
    inclusive: bool = False

    def shown(self) -> list[str]:
        return [self.reference, self.bank, self.when, self.created, self.amount, self.rate]


def _sign_check(df: DataFrame, name: str, rule: str, zero_allowed: bool) -> Check:
    value = to_number(df, name)
    low = value < 0 if zero_allowed else value <= 0
    text = F.when(value.isNull(), F.concat(F.lit(f"{name} non numérique/manquant : "), raw_text(df, name))).otherwise(
        F.concat(F.lit(f"{name}="), number_text(value), F.lit(" < 0 (doit être positif ou nul)" if zero_allowed else " <= 0 (doit être strictement positif)"))
    )
    return Check(rule, value.isNull() | low, text)


def _order_check(df: DataFrame, earlier: str, later: str, same_day_allowed: bool, says_late: str) -> Check:
    """earlier must be before later (or on its day); either unreadable violates."""
    a, b = to_day(df, earlier), to_day(df, later)
    late = a > b if same_day_allowed else a >= b
    text = (
        F.when(a.isNull(), F.concat(F.lit(f"{earlier} non parsable : "), raw_text(df, earlier)))
        .when(b.isNull(), F.concat(F.lit(f"{later} non parsable : "), raw_text(df, later)))
        .otherwise(F.concat(F.lit(f"{earlier}="), a.cast("string"), F.lit(f" {says_late} {later}="), b.cast("string")))
    )
    return Check("DATE_VALIDITY", a.isNull() | b.isNull() | late, text)


def template_gaps(df: DataFrame, cols: TransactionColumns) -> list[tuple[str, Column]]:
    """What a message without activity must not have, with names; absent columns don't count."""
    gaps = [(f"{c}!=NA", ~says(F.col(f"`{c}`"), "NA")) for c in cols.template if c in df.columns]
    if cols.country in df.columns:
        gaps.append((f"{cols.country}!={cols.country_idle}", ~says(F.col(f"`{cols.country}`"), cols.country_idle)))
    for c in (cols.amount, cols.rate):
        value = to_number(df, c)
        gaps.append((f"{c}!=0", value.isNull() | (F.abs(value) > EPSILON)))
    return gaps


def transaction_checks(df: DataFrame, cols: TransactionColumns = TransactionColumns()) -> list[Check]:
    gaps = template_gaps(df, cols)
    text = F.concat(F.lit(f"Message sans activité ({cols.reference}=NA) non conforme au gabarit : "), names_where(gaps))
    return [
        _sign_check(df, cols.amount, "AMOUNT_NON_NEGATIVE", True),
        _sign_check(df, cols.rate, "RATE_NON_NEGATIVE", True),
        _order_check(df, cols.when, cols.created, cols.inclusive, "postérieure à" if cols.inclusive else "non antérieure à"),
        Check("NO_ACTIVITY_CONFORMITY", says(F.col(f"`{cols.reference}`"), "NA") & any_of([c for _, c in gaps]), text),
    ]


def validate_transactions(df: DataFrame, cols: TransactionColumns = TransactionColumns()) -> tuple[DataFrame, DataFrame]:
    checks = transaction_checks(df, cols)
    return annotate(df, checks, "_TX_row_conforme"), anomalies(df, checks, cols.shown())


# ---- due dates ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class DueColumns:
    number: str = "NumCredoc"
    bank: str = "RefBanque"
    amount: str = "MontantEcheance"
    due: str = "DateEcheance"
    created: str = "dtCr"

    def shown(self) -> list[str]:
        return [self.number, self.bank, self.amount, self.due, self.created]


def due_checks(df: DataFrame, cols: DueColumns = DueColumns()) -> list[Check]:
    a, b = to_day(df, cols.due), to_day(df, cols.created)
    text = (
        F.when(a.isNull(), F.concat(F.lit(f"{cols.due} non parsable : "), raw_text(df, cols.due)))
        .when(b.isNull(), F.concat(F.lit(f"{cols.created} non parsable : "), raw_text(df, cols.created)))
        .otherwise(F.concat(F.lit(f"{cols.due}="), a.cast("string"), F.lit(f" non postérieure à {cols.created}="), b.cast("string")))
    )
    return [_sign_check(df, cols.amount, "AMOUNT_POSITIVE", False), Check("DATE_VALIDITY", a.isNull() | b.isNull() | (a <= b), text)]


def validate_due_dates(df: DataFrame, cols: DueColumns = DueColumns()) -> tuple[DataFrame, DataFrame]:
    checks = due_checks(df, cols)
    return annotate(df, checks, "_EC_row_conforme"), anomalies(df, checks, cols.shown())


# ---- statements -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class StatementColumns:
    bank: str = "RefBanque"
    correspondent: str = "NomCorrespondant"
    currency: str = "Devise"
    account: str = "NumCompte"
    opening: str = "SoldeDebutJournee"
    debits: str = "TotalMvtsDebiteursJournee"
    credits: str = "TotalMvtsCrediteurs"
    closing: str = "SoldeFinJournee"
    day: str = "DateFinJournee"
    created: str = "dtCr"
    grouping: tuple[str, ...] = ("RefBanque", "NomCorrespondant", "NumCompte", "Devise")
    tolerance: float = 0.01
    amounts: tuple[str, ...] = field(init=False, default=())

    def __post_init__(self):
        object.__setattr__(self, "amounts", (self.opening, self.debits, self.credits, self.closing))

    def shown(self) -> list[str]:
        return [self.account, self.bank, self.opening, self.debits, self.credits, self.closing, self.day, self.created]


def no_activity_row(df: DataFrame, cols: StatementColumns) -> Column:
    return says(F.col(cols.correspondent), "NA") & says(F.col(cols.currency), "NA") & says(F.col(cols.account), "NA")


def statement_checks(df: DataFrame, cols: StatementColumns = StatementColumns()) -> list[Check]:
    opening, debits, credits, closing = numbers = [to_number(df, c) for c in cols.amounts]
    missing = any_of([n.isNull() for n in numbers])
    computed = opening + credits - debits
    delta = F.bround(closing - computed, 2)
    sums = F.when(missing, F.concat(F.lit("Champ(s) non numérique(s)/manquant(s) : "), names_where(list(zip(cols.amounts, [n.isNull() for n in numbers], strict=True))))).otherwise(
        F.concat(
            F.lit(f"{cols.closing}="), number_text(closing), F.lit(f" != {cols.opening}("), number_text(opening), F.lit(") + MvtsCrediteurs("), number_text(credits),
            F.lit(") - MvtsDebiteurs("), number_text(debits), F.lit(") = "), number_text(computed), F.lit(" (écart="), number_text(delta), F.lit(")"),
        )
    )
    ids = (cols.correspondent, cols.currency, cols.account)
    flags = [says(F.col(c), "NA") for c in ids]
    all_na = no_activity_row(df, cols)
    partial = any_of(flags) & ~all_na
    moved = [n.isNull() | (F.abs(n) > EPSILON) for n in numbers]
    idle = F.when(partial, F.concat(F.lit("NA partielle : "), names_where([(c, ~f) for c, f in zip(ids, flags, strict=True)]), F.lit(" non-NA alors que d'autres champs identifiants le sont"))).otherwise(
        F.concat(F.lit("Ligne 'sans activité' (NA) mais champ(s) non nul(s)/non numérique(s) : "), names_where(list(zip(cols.amounts, moved, strict=True))))
    )
    return [
        Check("ARITHMETIC", missing | (F.abs(delta) > cols.tolerance), sums, F.when(~missing, delta)),
        Check("NO_ACTIVITY_CONFORMITY", partial | (all_na & any_of(moved)), idle),
        _order_check(df, cols.day, cols.created, True, "postérieure à"),
    ]


def validate_statements(df: DataFrame, cols: StatementColumns = StatementColumns(), order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Row checks and the chaining of statements. Chaining doesn't lower a row's conformity, though it counts as anomalies.

    order names the columns that tell which of two statements of one instant came first.
    """
    from .chaining import temporal_continuity

    checks = statement_checks(df, cols)
    marked = annotate(df, checks, "_NC_row_conforme").withColumn("_NC_is_no_activity_row", no_activity_row(df, cols))
    rows = anomalies(df, checks, cols.shown(), with_delta=True)
    return marked, rows.unionByName(temporal_continuity(df, cols, order or []))
