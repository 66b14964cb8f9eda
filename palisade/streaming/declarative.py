"""The same flows for Spark Declarative Pipelines.

The graph needs the pipelines command line (and its gRPC dependencies) to run; this module
only registers tables and flows, with the builders that the runner uses as well.
"""

from __future__ import annotations

from palisade.streaming.runner import Runner


def declare(runner: Runner, tables_comment: dict[str, str] | None = None) -> None:
    """Registers every flow of ``runner``: one streaming table a target, one append flow each."""
    from pyspark import pipelines as dp

    for target in dict.fromkeys(f.target for f in runner.flows.values()):
        dp.create_streaming_table(target, comment=(tables_comment or {}).get(target))
    for f in runner.flows.values():
        dp.append_flow(target=f.target, name=f.name)(lambda f=f: f.build(runner.spark))
