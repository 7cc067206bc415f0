"""Reports in Markdown, made of small aggregates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import duration_text, grouped_int, percent_text, report_cell


def table(df: DataFrame, headers: list[str], numeric: tuple[int, ...] = (), total: list[str] | None = None, most: int = 10_000) -> str:
    """A Markdown table of a small table's rows; numeric columns stand right."""
    rows = [[str(v) for v in r] for r in df.limit(most).collect()]
    line = lambda cells: "| " + " | ".join(c.replace("|", "\\|") for c in cells) + " |"
    rule = "|" + "|".join("---:" if i in numeric else "---" for i in range(len(headers))) + "|"
    return "\n".join([line(headers), rule, *map(line, rows), *([line(total)] if total else [])])


def quality_markdown(api_id: str, mode: str, started: datetime, seconds: float, run: DataFrame, history: DataFrame) -> str:
    """Indicators over the history, and the time of this run."""
    r, h = run.first(), history.first()
    number = lambda n: f"{n:,}".replace(",", " ")
    share = lambda x: f"{x:.1f}".replace(".", ",") + " %"
    rows = [
        ("Lignes traitées", number(r["n_rows"])), ("Taux de conformité", share(r["taux_conformite_pct"])), ("Taux d'outliers", share(r["taux_outliers_pct"])),
        ("Valeurs distinctes", number(h["n_distinct_total"])), ("Valeurs normalisées", number(h["n_distinct_normalized"])),
        ("Déjà propres à la source", f"{number(h['n_already_clean'])} ({share(h['already_clean_pct'])})"), ("Nettoyées", f"{number(h['n_cleaned'])} ({share(h['cleaned_pct'])})"),
        ("Outliers", f"{number(h['n_outliers'])} ({share(h['outliers_pct'])})"), ("Temps total d'exécution", duration_text(seconds)),
    ]
    return "\n".join([f"# Rapport de qualité — {api_id}", "", f"{mode} | {started:%d/%m/%Y}", "", "| Indicateur | Valeur |", "|---|---:|", *(f"| {a} | {b} |" for a, b in rows), ""])


def outlier_markdown(api_id: str, mode: str, started: datetime, synthesis: DataFrame, banks: DataFrame, listed: int, known: int) -> str:
    """Outliers by field and by bank (listed of known banks)."""
    whole = synthesis.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(grouped_int(F.col("n")).alias("n")).first()["n"]
    fields = table(synthesis.select(report_cell(F.col("label")).alias("a"), grouped_int(F.col("n")).alias("b"), percent_text(F.col("pct")).alias("c")), ["Champ traité", "Nb valeurs outliers", "% du total"], (1, 2), ["TOTAL", whole, "100,0 %"])
    per = table(banks.select(report_cell(F.col("bank")).alias("a"), grouped_int(F.col("n")).alias("b"), percent_text(F.col("pct")).alias("c")), ["RefBanque", "Nb occurrences", "% du total"], (1, 2)) if known else "*Aucun outlier détecté sur cette période.*"
    more = f"\n\n*{listed} banques les plus concernées sur {known} au total.*" if listed < known else ""
    return "\n".join([f"# Rapport des outliers — {api_id}", "", f"{mode} | {started:%d/%m/%Y}", "", "## Répartition par champ traité", "", fields, "", "## Répartition par RefBanque", "", per + more, ""])
