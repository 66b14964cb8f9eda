"""Activity names and ids of the Open Cybersecurity Schema Framework."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Activities by id; what is not listed is OTHER.
OTHER = "Other"
NETWORK = {0: "Unknown", 1: "Open", 2: "Close", 3: "Reset", 4: "Fail", 5: "Refuse", 6: "Traffic", 7: "Listen"}
DNS = {0: "Unknown", 1: "Query", 2: "Response", 6: "Traffic"}
HTTP = {0: "Unknown", 1: "Connect", 2: "Delete", 3: "Get", 4: "Head", 5: "Options", 6: "Post", 7: "Put", 8: "Trace", 9: "Patch"}
FILE = {
    0: "Unknown", 1: "Create", 2: "Read", 3: "Update", 4: "Delete", 5: "Rename", 6: "Set Attributes", 7: "Set Security", 8: "Get Attributes", 9: "Get Security",
}
HTTP_VERBS = {"": 0} | {name.lower(): i for i, name in HTTP.items() if i}
OTHER_ID = 99


def _lookup(key: Column, values: dict, default: object) -> Column:
    out = F.when(F.lit(False), F.lit(default))
    for k, v in values.items():
        out = out.when(key == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))


def ocsf_network_activity_name(activity_id: Column) -> Column:
    return _lookup(activity_id, NETWORK, OTHER)


def ocsf_dns_activity_name(activity_id: Column) -> Column:
    return _lookup(activity_id, DNS, OTHER)


def ocsf_http_activity_name(activity_id: Column) -> Column:
    return _lookup(activity_id, HTTP, OTHER)


def ocsf_file_activity_name(activity_id: Column) -> Column:
    """Ids from 10 on are ``Other``: the mapping followed here ends at 9."""
    return _lookup(activity_id, FILE, OTHER)


def ocsf_http_activity_id(verb: Column) -> Column:
    """Id of an HTTP verb in any case; 0 for '', 99 for null and unknown verbs."""
    return _lookup(F.lower(verb), HTTP_VERBS, OTHER_ID)
