"""ledgerlake: reconciliation and enrichment of operational tables on Spark.

functions/  Column -> Column key normalisation, parsing, month helpers
operators/  DataFrame -> DataFrame lookups, netting, rules, history,
            summary, profiling, cleaning and audit tables
sources/    discovery by header signature, readers, validation, sinks
plans/      session/lineage settings, the end-to-end flow, the registered
            driver queries and their DuckDB oracles
streaming/  stream-static incremental enrichment of arriving order lines
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming"]
