"""Headline timings: one JSON line.

The fact is built from the test tables and stored, the documents are built from it and stored, and the
questions run on what is stored. ``queries`` holds the seconds of each step.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

os.environ.setdefault("PYTHONWARNINGS", "ignore")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cadastra.operators.filters import apply_filters  # noqa: E402
from cadastra.plans import documents, metrics, search, sheet, store  # noqa: E402
from cadastra.plans.fact import opted_in_companies, opted_in_keys  # noqa: E402
from cadastra.session import build_session, shared_dir  # noqa: E402
from cadastra.sources import gold  # noqa: E402
from checks.catalog import ACTIVITY, CLOSINGS, STATE, WINDOW  # noqa: E402
from checks.tables import Registry  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        f"local[{cpus}]",
        app="bench",
        **{"spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "12g"},
    )
    registry = Registry(spark, folder)
    base = f"{shared_dir(spark)}/bench-{uuid.uuid4().hex}"
    seconds: dict[str, float] = {}

    def timed(name: str, step) -> None:
        start = time.perf_counter()
        result = step()
        if result is not None:
            result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)

    spark.range(1000).selectExpr("sum(id)").collect()
    timed("hot_keys", lambda: registry.hot and None)
    timed("build_gold", lambda: gold.write_snapshot(registry.fact, f"{base}/fato", "20250101") and None)
    fact = gold.read(spark, f"{base}/fato")
    keys = opted_in_keys(registry.tax_regime)
    companies = opted_in_companies(registry.companies, keys, ["razao_social"])
    timed("build_documents", lambda: store.write_documents(documents.build_parts(fact, companies), f"{base}/docs", 64))

    docs = store.read_documents(spark, f"{base}/docs")
    activities, towns = registry.activities, registry.towns
    for name, step in {
        "kpis": lambda: metrics.headline_indicators(fact, WINDOW),
        "dist_situacao": lambda: metrics.status_distribution(fact, WINDOW),
        "top_cnaes": lambda: metrics.top_activities(fact, activities, 10, WINDOW),
        "annual_series": lambda: metrics.yearly_flow(fact, WINDOW, CLOSINGS),
        "monthly_series": lambda: metrics.monthly_flow(fact, WINDOW, CLOSINGS),
        "by_uf": lambda: metrics.by_state(fact, WINDOW),
        "top_municipios": lambda: metrics.top_towns(fact, towns, 15, WINDOW),
        "top_municipios_per_uf": lambda: metrics.top_towns_by_state(fact, towns, 5, WINDOW),
        "top_cnaes_detail": lambda: metrics.top_activities_detail(fact, activities, 20, WINDOW),
        "cnae_by_situacao": lambda: metrics.activity_by_status(fact, activities, 10, WINDOW),
        "top_cnae_evolution": lambda: metrics.activity_evolution(fact, activities, 5, WINDOW),
        "filters": lambda: apply_filters(fact, states=[STATE], statuses=[2]).groupBy("uf").count(),
        "doc_by_key": lambda: documents.nested(store.documents_by_id(spark, f"{base}/docs", 11)),
        "doc_by_uf_cnae": lambda: documents.nested(search.by_state_and_activity(docs, STATE, ACTIVITY)),
        "doc_count_by_uf": lambda: search.count_by_state(docs),
        "company_sheet": lambda: sheet.company_sheets(docs, activities, towns, registry.natures),
    }.items():
        timed(name, step)

    spark.stop()
    print(
        json.dumps(
            {
                "metric": "registry_load_and_analytics",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
