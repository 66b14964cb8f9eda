"""SQL functions of the same names, for use in ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from palisade.functions import community_id, ocsf, protocols


def _case(argument: str, values: dict, default: str) -> str:
    quote = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return f"CASE {argument} " + " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in values.items()) + f" ELSE {default} END"


def definitions() -> dict[str, tuple[str, str, str]]:
    """name → (arguments, result type, expression)."""
    names = {
        "ocsf_network_activity_name": ocsf.NETWORK,
        "ocsf_dns_activity_name": ocsf.DNS,
        "ocsf_http_activity_name": ocsf.HTTP,
        "ocsf_file_activity_name": ocsf.FILE,
    }
    out = {n: ("activity_id INT", "STRING", _case("activity_id", v, f"'{ocsf.OTHER}'")) for n, v in names.items()}
    out["ocsf_http_activity_id"] = ("verb STRING", "INT", _case("lower(verb)", ocsf.HTTP_VERBS, str(ocsf.OTHER_ID)))
    out["proto_name_to_code"] = ("name STRING", "INT", _case("lower(name)", protocols.CODES, "NULL"))
    out["proto_code_to_name"] = ("code INT", "STRING", _case("code", protocols.PROTOCOLS, f"'{protocols.UNASSIGNED}'"))
    return out


def register_all(spark: SparkSession) -> list[str]:
    """Creates the temporary functions and returns their names."""
    for name, (arguments, kind, body) in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")

    @F.udf("string", useArrow=True)
    def flow(src_ip, src_port, dst_ip, dst_port, proto, seed):
        return community_id.community_id(src_ip, src_port, dst_ip, dst_port, proto)

    spark.udf.register("community_id_hash", flow)
    return [*definitions(), "community_id_hash"]
