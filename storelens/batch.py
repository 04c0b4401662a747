"""The whole daily run: check the tables, stop on a fault, publish marts and figures."""

from __future__ import annotations

from pyspark.sql import DataFrame

from storelens.plans import marts, quality
from storelens.session import scratch, write_once
from storelens.sources import publish
from storelens.sources.star import CsvBundle, Star


class QualityFailed(RuntimeError):
    """Raised before anything is published when a check fails."""


def run_batch(star: Star, folder: str, form: str = "parquet", by_date: bool = False, strict: bool = True,
              metadata: str | None = None, **quality_options) -> DataFrame:
    """Write the quality report, the marts, the headline figures and the memo facts under ``folder``.

    With ``strict`` a failed check stops the run after its report is written. Further options go to
    ``quality_report``; ``metadata`` is the path of the bundle's JSON, whose stated order count the
    report compares. A ``CsvBundle`` adds its unreadable records, and every count that its JSON states. The report
    keeps up to ``samples`` keys of violating rows per check. Intermediate tables are removed at the end. Orders are priced once for marts, figures and memo. Returns the published row counts.
    """
    folder = folder.rstrip("/")
    with scratch(star.spark):
        if metadata and "expected_orders" not in quality_options:
            quality_options["expected_orders"] = quality.expected_row_count(star.spark, metadata)
        quality_options.setdefault("samples", quality.SAMPLES)
        report = quality.quality_report(star, **quality_options)
        if isinstance(star, CsvBundle):
            checks = quality.bundle_checks(star, metadata, quality_options["samples"])
            report = report.unionByName(checks if "sample" in report.columns else checks.drop("sample"))
        report = write_once(report, "quality")
        publish.write_quality_report(report, f"{folder}/quality_report")
        failed = [r["check"] for r in report.where("not passed").select("check").collect()]
        if failed and strict:
            raise QualityFailed("; ".join(failed))
        priced = publish.PricedStar(star)
        counts = publish.publish_marts(priced, f"{folder}/marts", form, by_date)
        publish.write_executive_kpis(priced, f"{folder}/executive_kpis")
        marts.executive_memo_facts(priced).write.mode("overwrite").json(f"{folder}/executive_memo_facts")
        return counts
