"""Schemas that drift between files: detect each change, read all files into one table.

Method: the schema of each file is a tree: JSON objects are inner nodes, other keys are leaves that
carry a profile of their values, and properties of the file (its dataset label, the form of a time
text) are leaves that carry their value. Consecutive files of a stream are compared by tree edit
distance; the minimum-cost script of adds, deletes, renames, moves and relabels is the report, and
the scripts of all files compile into one projection that reads every layout.

Scale: messages are profiled partition by partition in Arrow batches and reduced to one
row a (file, path) and one a word in it; only files that differ from their predecessor reach
the tree matching. Words are counted whole and compared by a join, so no task holds a field's
vocabulary. Windows run over files or (stream, path), never over messages.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.storage import materialize, workspace

FLUSH = 20_000  # (file, path) entries a task gathers before it passes them on
FLUSH_WORDS = 400_000  # and words in them

# Kinds of values. Fixed patterns, tried in this order.
_KINDS = [
    ("empty", re.compile(r"\s*$")),
    ("time", re.compile(r"\d{4}-\d\d-\d\d[T ]\d\d:\d\d")),
    ("ipv4", re.compile(r"\d{1,3}(?:\.\d{1,3}){3}$")),
    ("url", re.compile(r"[a-z][a-z0-9+.-]*://", re.I)),
    ("fuzzy", re.compile(r"\d+:[A-Za-z0-9+/]+:[A-Za-z0-9+/]+$")),
    ("digits", re.compile(r"[+-]?\d+(?:\.\d+)?$")),
    ("mime", re.compile(r"[a-z]+/[a-z0-9.+-]+$")),
    ("text", re.compile(r".*\s", re.S)),
    ("host", re.compile(r"[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}$", re.I)),
]
_HEX = re.compile(r"(?:T1)?[0-9a-fA-F]{16,}$")


def kind_of(value: object) -> str:
    """A coarse sort of value, such that values of one field agree on it."""
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, (int, float)):
        return f"num{len(str(int(abs(value))))}" if abs(value) < 1e18 else "num19"
    if isinstance(value, list):
        return "array"
    if _HEX.match(value):
        return f"hex{len(value)}"
    return next((name for name, pattern in _KINDS if pattern.match(value)), "word")


def json_type(value: object) -> str | None:
    if value is None:
        return None
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "number"
    return "array" if isinstance(value, list) else "string"


def leaves(node: dict) -> Iterator[tuple[tuple[str, ...], object]]:
    """Keys down to each leaf and its value; arrays are leaves, an object without keys has none."""
    stack = [((), node)]
    while stack:
        keys, obj = stack.pop()
        for key, value in obj.items():
            if isinstance(value, dict):
                stack.append(((*keys, key), value))
            else:
                yield (*keys, key), value


_PROFILE = "source_file string, path string, word string, n bigint, kinds map<string,bigint>, types map<string,bigint>, forms map<string,bigint>"


_TOKEN = re.compile(r"[^\W\d_]{2,}")


def tokens_of(value: object) -> list[str]:
    """What a field's values have in common beyond their kind: the words in them."""
    if isinstance(value, str):
        return [] if _HEX.match(value) else _TOKEN.findall(value.lower())
    if isinstance(value, list):
        return [t for x in value if isinstance(x, str) for t in tokens_of(x)]
    return []


def _profiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[tuple[str, str], list] = {}
    n_words = 0

    def flush() -> pd.DataFrame:
        rows = []
        for (f, p), e in held.items():
            rows.append((f, p, None, e[0], dict(e[1]), dict(e[2]), {json.dumps(k): c for k, c in e[4].items()}))
            rows += [(f, p, w, c, None, None, None) for w, c in e[3].items()]
        held.clear()
        return pd.DataFrame(rows, columns=["source_file", "path", "word", "n", "kinds", "types", "forms"])

    for pdf in batches:
        for file, message in zip(pdf["source_file"], pdf["message"]):
            try:
                doc = json.loads(message)
            except (ValueError, TypeError, RecursionError):
                continue  # null or cut off
            if not isinstance(doc, dict):
                continue
            for keys, value in leaves(doc):
                path = ".".join(keys)
                entry = held.get((file, path))
                if entry is None:
                    entry = held[file, path] = [0, Counter(), Counter(), Counter(), Counter()]
                entry[0] += 1
                if len(keys) > 1 or "." in path:
                    entry[4][keys] += 1
                if value is None:
                    continue
                entry[1][kind_of(value)] += 1
                entry[2][json_type(value)] += 1
                if isinstance(value, float):
                    entry[2]["float"] += 1  # beside "number", which counts it too
                words = entry[3]
                before = len(words)
                words.update(tokens_of(value))
                n_words += len(words) - before
            if len(held) > FLUSH or n_words > FLUSH_WORDS:
                yield flush()
                n_words = 0
    if held:
        yield flush()


def file_schemas(messages: DataFrame) -> DataFrame:
    """(source_file, message) → a row a (source_file, path), with kinds and json_type, and a row
    a word of its values (``word`` is null in the former), each with its count ``n``.

    ``json_type`` is the type of most non-null values, null where all are null; in ``types``, ``float``
    counts the numbers that are no integers once more. ``forms`` has the
    keys that make up the path, as JSON lists: a dot in it may part keys or be in one.
    """
    parts = messages.where("source_file is not null and message is not null").select("source_file", "message").mapInPandas(_profiles, _PROFILE)

    keys = ["source_file", "path", "word"]
    # partials of one (file, path) come from as many tasks as hold the file; each has a bounded size
    agg = parts.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.collect_list("kinds").alias("_k"),
        F.collect_list("types").alias("_t"),
        F.collect_list("forms").alias("_f"),
    )

    def total(col: str) -> Column:
        entries = F.flatten(F.transform(col, lambda m: F.map_entries(m)))
        names = F.array_sort(F.array_distinct(F.transform(entries, lambda e: e["key"])))
        count = lambda k: F.aggregate(F.filter(entries, lambda e: e["key"] == k), F.lit(0).cast("bigint"), lambda a, e: a + e["value"])
        return F.map_from_arrays(names, F.transform(names, count))

    out = agg.select(*keys, "n", total("_k").alias("kinds"), total("_t").alias("types"), total("_f").alias("forms"))
    best = F.array_max(F.transform(F.map_entries("types"), lambda e: F.struct(e["value"].alias("v"), e["key"].alias("k"))))["k"]
    return out.withColumn("json_type", best)


def strangeness(met: float, mass: float, total: float) -> float:
    """How far the words that repeat within a field (``mass`` of its ``total`` words) are missed
    in another, which has ``met`` of them; where none repeats, the kind decides."""
    return (1 - met / mass) * min(1.0, 1.5 * mass / total) if mass else 0.0


def strange_words(x: dict[str, int], y: dict[str, int]) -> float:
    repeated = {w: c for w, c in x.items() if c > 1}
    return strangeness(sum(c for w, c in repeated.items() if w in y), sum(repeated.values()), sum(x.values()))


def value_distance(a: dict | None, b: dict | None, strange: float | None = None) -> float:
    """0 for the same sort of values, 1 for different sorts, from kinds and words.

    ``strange`` is what the words say, where it is known; else the profiles have their words.
    """
    if not a or not b or not a["kinds"] or not b["kinds"]:
        return 1.0
    na, nb = sum(a["kinds"].values()), sum(b["kinds"].values())
    kinds = sum(abs(a["kinds"].get(k, 0) / na - b["kinds"].get(k, 0) / nb) for k in {*a["kinds"], *b["kinds"]}) / 2
    if strange is None:
        strange = max(strange_words(a["words"], b["words"]), strange_words(b["words"], a["words"]))
    return min(1.0, kinds + strange)


def label_distance(a: str, b: str) -> float:
    """0 for equal keys, else 1 minus the share of common letter pairs."""
    x, y = a.lower().replace("_", ""), b.lower().replace("_", "")
    if x == y:
        return 0.0
    gx, gy = Counter(zip(x, x[1:])), Counter(zip(y, y[1:]))
    both = sum((gx & gy).values())
    return 1 - 2 * both / max(1, sum(gx.values()) + sum(gy.values()))


def _assign(cost: np.ndarray) -> list[int]:
    """Minimum-cost assignment of each row to a column (square matrix), by shortest augmenting paths."""
    n = len(cost)
    u, v, match = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1, dtype=int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, used, way = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=bool), np.zeros(n + 1, dtype=int)
        while match[j0]:
            used[j0] = True
            cur = np.append(np.inf, cost[match[j0] - 1] - u[match[j0]] - v[1:])
            better = ~used & (cur < least)
            least[better], way[better] = cur[better], j0
            j1 = int(np.argmin(np.where(used, np.inf, least)))
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    out = [0] * n
    for j in range(1, n + 1):
        out[match[j] - 1] = j - 1
    return out


def _pairs(gone: list, come: list, cost: Callable, delete: Callable, add: Callable) -> tuple[float, list[tuple]]:
    """The cheapest way to turn ``gone`` into ``come``: its cost, and what becomes what."""
    n = len(gone) + len(come)
    table = np.zeros((n, n))
    for i in range(n):
        for j in range(n):
            if i < len(gone):
                table[i, j] = cost(gone[i], come[j]) if j < len(come) else delete(gone[i])
            elif j < len(come):
                table[i, j] = add(come[j])
    total, out = 0.0, []
    for i, j in enumerate(_assign(table)):
        total += table[i, j]
        if i < len(gone) and j < len(come) and table[i, j] < delete(gone[i]) + add(come[j]):
            out.append((gone[i], come[j]))
    return total, out


DELETE = ADD = 1.0
VALUE_WEIGHT, LABEL_WEIGHT, MOVE_WEIGHT = 2.6, 0.4, 0.2


class Tree:
    """The nodes of a set of dotted paths: ``children`` of each inner node and its number of leaves."""

    def __init__(self, paths: list[str]):
        self.leaves = set(paths)
        self.children: dict[str, list[str]] = {"": []}
        self.size: Counter = Counter()
        for path in sorted(paths):
            self.size[path] += 1
            node = path
            while node:
                up = node.rpartition(".")[0]
                new = up not in self.children
                self.children.setdefault(up, [])
                if node not in self.children[up]:
                    self.children[up].append(node)
                self.size[up] += 1
                node = up if new or up else ""

    def inner(self, node: str) -> list[str]:
        return [c for c in self.children.get(node, []) if c in self.children]


def tree_distance(old: Tree, new: Tree, leaf: Callable[[str, str], float]) -> tuple[float, dict[str, str]]:
    """Edit distance of two unordered trees, and which inner node corresponds to which.

    Constrained edit distance: children of nodes that correspond are matched at minimum cost, a
    node may be put in or taken out between a parent and its children, and subtrees that stay
    unmatched are deleted or added leaf by leaf.
    """
    known: dict[tuple[str, str], tuple[float, list]] = {}

    def distance(a: str, b: str) -> tuple[float, list]:
        if (a, b) in known:
            return known[a, b]
        known[a, b] = (float("inf"), [])
        inside = lambda x, y: old.size[a] * DELETE + new.size[b] * ADD - old.size[x] * DELETE - new.size[y] * ADD + MOVE_WEIGHT
        ways = []
        if a in old.children and b in new.children:
            relabel = 0.0 if a == b else MOVE_WEIGHT
            cost, matched = _pairs(old.children[a], new.children[b], lambda x, y: distance(x, y)[0], lambda x: old.size[x] * DELETE, lambda y: new.size[y] * ADD)
            ways.append((cost + relabel, [(a, b), *matched]))
        elif a in old.leaves and b in new.leaves:
            ways.append((leaf(a, b), []))
        ways += [(distance(a, y)[0] + inside(a, y), [(a, y)]) for y in new.children.get(b, [])]
        ways += [(distance(x, b)[0] + inside(x, b), [(x, b)]) for x in old.children.get(a, [])]
        known[a, b] = min(ways, key=lambda w: w[0], default=(float("inf"), []))
        return known[a, b]

    total, todo = distance("", "")
    same: dict[str, str] = {}
    todo = list(todo)
    while todo:
        a, b = todo.pop()
        if a in same:
            continue
        cost, below = known.get((a, b), (0.0, []))
        if below[:1] == [(a, b)] and a in old.children and b in new.children:
            same[a] = b
            todo += below[1:]
        else:
            todo += [p for p in below if p != (a, b)]
    return total, same


def tree_edit_script(
    old: dict[str, dict], new: dict[str, dict], strange: Callable[[str, str], float] | None = None, kept: dict[str, tuple[dict, dict]] | None = None
) -> list[tuple[str, str, str]]:
    """Minimum-cost script between the trees of the paths ``old`` and ``new``.

    Values are profiles; ``strange`` gives what the words of two paths say, where the profiles
    have none. Paths in both trees are in ``kept``, with both profiles. Operations: ("delete",
    path, ""), ("add", path, ""), ("rename", path, new_path) for another key under the same or the
    corresponding parent, ("move", path, new_path) for another parent, ("retype", path, "") where the
    type of a leaf differs, and ("relabel", path, value) for the value of a property. A matched
    leaf costs its value distance, label distance and the move, which leaves of one parent that go
    to one other share; where that is dearer than a delete and an add, these stand.
    """
    gone, come = sorted(set(old) - set(new)), sorted(set(new) - set(old))
    parent = lambda p: p.rpartition(".")[0]
    leaf_costs: dict[tuple[str, str], float] = {}

    def leaf(a: str, b: str) -> float:
        if (a, b) not in leaf_costs:
            label = label_distance(a.rpartition(".")[2], b.rpartition(".")[2])
            leaf_costs[a, b] = VALUE_WEIGHT * value_distance(old[a], new[b], strange and strange(a, b)) + LABEL_WEIGHT * label
        return leaf_costs[a, b]

    script: list[tuple[str, str, str]] = []
    if gone or come:
        same = tree_distance(Tree(gone), Tree(come), leaf)[1] if gone and come else {}
        shared = Counter((parent(a), parent(b)) for a in gone for b in come if a.rpartition(".")[2] == b.rpartition(".")[2])

        def cost(a: str, b: str) -> float:
            at, to = parent(a), parent(b)
            return leaf(a, b) + (0.0 if at == to else MOVE_WEIGHT / max(1, shared[at, to]))

        _, matched = _pairs(gone, come, cost, lambda a: DELETE, lambda b: ADD)
        became = dict(matched)
        for a in gone:
            b = became.get(a)
            if b is None:
                script.append(("delete", a, ""))
                continue
            script.append(("rename" if same.get(parent(a), parent(a)) == parent(b) else "move", a, b))
            was, now = old[a].get("type"), new[b].get("type")
            if was and now and was != now:
                script.append(("retype", b, ""))
        script += [("add", b, "") for b in come if b not in became.values()]
    for path, (was, now) in (kept or {}).items():
        if was["type"] and now["type"] and was["type"] != now["type"]:
            script.append(("relabel", path, now["type"]) if now.get("node") == "label" else ("retype", path, ""))
    return script


def _dict(value: object) -> dict:
    return dict(value) if value is not None else {}


_CHANGE = "src string, source_file string, field string, change string, new_field string"
_REPORT = {"delete": "removed", "add": "added", "rename": "renamed", "move": "renamed", "retype": "retyped", "relabel": "renamed"}


def _script_of_file(pdf: pd.DataFrame) -> pd.DataFrame:
    """One file's differing nodes → its report. ``side`` is 'old', 'new' or 'both'; or 'words-old' or
    'words-new' with a path's repeated words ``x`` and all words ``y``; or 'met' with the repeated words of
    ``path`` that ``other`` has (``x``), and the other way round (``y``)."""
    sides: dict[str, dict] = {"old": {}, "new": {}}
    kept: list[tuple[str, dict, dict]] = []
    mass: dict[tuple, tuple[float, float]] = {}
    met: dict[tuple, tuple[float, float]] = {}
    for r in pdf.itertuples():
        if r.side == "met":
            met[r.path, r.other] = r.x, r.y
        elif r.side.startswith("words-"):
            mass[r.side[6:], r.path] = r.x, r.y
        elif r.side == "both":
            kept.append((r.path, {"type": r.last_type}, {"type": r.json_type, "node": r.node}))
        else:
            sides[r.side][r.path] = {"kinds": _dict(r.kinds), "type": r.json_type}

    def strange(a: str, b: str) -> float:
        x, y = met.get((a, b), (0, 0))
        return max(strangeness(x, *mass.get(("old", a), (0, 0))), strangeness(y, *mass.get(("new", b), (0, 0))))

    script = tree_edit_script(sides["old"], sides["new"], strange)
    for path, was, now in kept:  # a property may be called like a key
        script += tree_edit_script({}, {}, kept={path: (was, now)})
    out = pd.DataFrame([(path, _REPORT[op], new) for op, path, new in script], columns=["field", "change", "new_field"])
    out.insert(0, "source_file", pdf["source_file"].iloc[0])
    out.insert(0, "src", pdf["src"].iloc[0])
    return out


def stream_of(file: Column) -> Column:
    """Directory part of a file name; '' where there is none."""
    return F.regexp_extract(file, r"^(.*)/[^/]*$", 1)


def property_nodes(rows: DataFrame, file: str, value: Column, name: str, node: str) -> DataFrame:
    """A property of each file as a node of its tree: the value of most rows that have one.

    ``node`` is ``label`` (its changes are renames to the new value) or ``form`` (retypes).
    Returns (source_file, path, json_type, node); files without a value have no row.
    """
    counts = rows.where(F.col(file).isNotNull() & value.isNotNull()).groupBy(F.col(file).alias("source_file"), value.alias("_v")).count()
    of_file = counts.groupBy("source_file").agg(F.max(F.struct("count", "_v"))["_v"].alias("json_type"))
    return of_file.select("source_file", F.lit(name).alias("path"), "json_type", F.lit(node).alias("node"))


def message_changes(schemas: DataFrame | None, properties: DataFrame | None = None, src: str = "") -> DataFrame:
    """(src, source_file, field, change, new_field): the edit script of each file of a source.

    ``schemas`` has the rows of :func:`file_schemas`, ``properties`` those of
    :func:`property_nodes`; either may be None. A file without a readable message has no schema
    and is passed over: the next file is compared with the last one that has. The last known
    type and values of a path hold over files where it is present with nulls only; a rename
    hands them on to the new path. A property is compared with its last known value.
    """
    groups = None
    if schemas is not None:
        groups = _differing(schemas)
    if properties is not None:
        before = F.lag("json_type").over(Window.partitionBy(stream_of(F.col("source_file")), "path").orderBy("source_file"))
        other = properties.withColumn("last_type", before).where("json_type <> last_type").withColumn("side", F.lit("both"))
        groups = other if groups is None else groups.unionByName(other, allowMissingColumns=True)
    spark = groups.sparkSession
    empty = spark.createDataFrame([], "source_file string, side string, path string, other string, node string, kinds map<string,bigint>, json_type string, last_type string, x bigint, y bigint")
    groups = empty.unionByName(groups, allowMissingColumns=True).withColumn("src", F.lit(src))
    # a group is one file's differing paths and pairs of them: bounded by the width of a schema. The number of
    # partitions is given, since these few rows are much work and would else be put into one task
    groups = groups.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "source_file")
    return groups.groupBy("source_file").applyInPandas(_script_of_file, _CHANGE)


def _differing(schemas: DataFrame) -> DataFrame:
    """The nodes of each file that its predecessor has not, or not alike, with what tells them apart."""
    rows = schemas.where("word is null").drop("word").withColumn("stream", stream_of(F.col("source_file")))
    files = rows.select("stream", "source_file").distinct()
    by_file = Window.partitionBy("stream").orderBy("source_file")
    files = files.withColumn("idx", F.row_number().over(by_file)).withColumn("next_file", F.lead("source_file").over(by_file))
    rows = rows.join(files, ["stream", "source_file"])
    by_path = Window.partitionBy("stream", "path").orderBy("idx")
    known = by_path.rowsBetween(Window.unboundedPreceding, 0)
    filled = F.size("kinds") > 0
    rows = (
        rows.withColumn("before", F.lag("idx").over(by_path))
        .withColumn("after", F.lead("idx").over(by_path))
        .withColumn("last_type", F.last("json_type", ignorenulls=True).over(by_path.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("known_type", F.last("json_type", ignorenulls=True).over(known))
        .withColumn("known_kinds", F.last(F.when(filled, F.col("kinds")), ignorenulls=True).over(known))
        .withColumn("known_file", F.last(F.when(filled, F.col("source_file")), ignorenulls=True).over(known))
    )
    come = rows.where("idx > 1 and (before is null or before < idx - 1)").select(
        "source_file", "path", F.lit("new").alias("side"), "kinds", F.col("source_file").alias("words_of"), "json_type", "last_type"
    )
    gone = rows.where("next_file is not null and (after is null or after > idx + 1)").select(
        F.col("next_file").alias("source_file"), "path", F.lit("old").alias("side"), F.col("known_kinds").alias("kinds"),
        F.col("known_file").alias("words_of"), F.col("known_type").alias("json_type"), "last_type",
    )
    other = rows.where("before = idx - 1 and json_type <> last_type").select(
        "source_file", "path", F.lit("both").alias("side"), "kinds", F.lit(None).cast("string").alias("words_of"), "json_type", "last_type"
    )
    # the words of both sides, counted and matched without gathering any field's words
    sides = come.unionByName(gone)
    words = schemas.where("word is not null").select(F.col("source_file").alias("words_of"), "path", "word", "n")
    words = sides.select("source_file", "side", "path", "words_of").join(words, ["words_of", "path"])
    again = F.when(F.col("n") > 1, F.col("n")).otherwise(0)
    mass = words.groupBy("source_file", F.concat(F.lit("words-"), "side").alias("side"), "path").agg(F.sum(again).alias("x"), F.sum("n").alias("y"))
    side = lambda which, path, count: words.where(F.col("side") == which).select("source_file", "word", F.col("path").alias(path), again.alias(count))
    met = side("old", "path", "x").join(side("new", "other", "y"), ["source_file", "word"]).groupBy("source_file", "path", "other")
    met = met.agg(F.sum("x").alias("x"), F.sum("y").alias("y")).withColumn("side", F.lit("met"))
    out = sides.unionByName(other).drop("words_of").withColumn("node", F.lit("key"))
    return out.unionByName(mass, allowMissingColumns=True).unionByName(met, allowMissingColumns=True)


def text_form(ts: Column) -> Column:
    """Digits with a point, digits only, or any other text; null for null."""
    return F.when(ts.rlike(r"^\d+\.\d+$"), "decimal").when(ts.rlike(r"^\d+$"), "integer").when(ts.isNotNull(), "text")


_MAP = "source_file string, layout map<string,string>"


def _maps_of_stream(groups: dict[str, str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A stream's scripts in the order of its files → the map from path to column after each.

    A rename hands its column on. A path that comes takes the column it had in this stream
    before, else its group's, else one of its own: never one that another path of the file has.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        live: dict[str, str] = {}
        past: dict[str, str] = {}
        rows = []
        for file, script in pdf.sort_values(["source_file", "change", "field"]).groupby("source_file"):
            moved = []
            for r in script.itertuples():
                if r.change in ("removed", "renamed") and r.field in live:
                    past[r.field] = live.pop(r.field)
                    moved += [(r.new_field, past[r.field])] if r.change == "renamed" else []
            live.update(moved)
            held = set(live.values())
            for path in script.loc[script["change"] == "added", "field"]:
                own = (f"{path}#{n}" for n in count(2))
                live[path] = next(c for c in chain((past.get(path), groups.get(path, path), path), own) if c and c not in held)
                held.add(live[path])
            rows.append((file, dict(live)))
        return pd.DataFrame(rows, columns=["source_file", "layout"])

    return run


def path_groups(schemas: DataFrame, changes: DataFrame) -> dict[str, str]:
    """Paths that renames link, by the path most files have; never two that one file has.

    Only the distinct paths, links and sets of linked paths in files come to the driver: the
    width of the schema, not its files.
    """
    rows = schemas.where("word is null")
    widths = {r.path: r["count"] for r in rows.groupBy("path").count().collect()}
    links = changes.where("change = 'renamed'").groupBy("field", "new_field").count().collect()
    linked = schemas.sparkSession.createDataFrame([(p,) for p in sorted({p for r in links for p in (r.field, r.new_field)})], "path string")
    sets = rows.join(F.broadcast(linked), "path").groupBy("source_file").agg(F.sort_array(F.collect_set("path")).alias("paths")).select("paths").distinct().collect()
    together: dict[str, set[str]] = {}
    for r in sets:
        for p in r.paths:
            together.setdefault(p, set()).update(r.paths)
    members = {p: {p} for p in widths}
    for r in sorted(links, key=lambda r: (-r["count"], r.field, r.new_field)):
        a, b = members.get(r.field), members.get(r.new_field)
        if a and b and a is not b and not any(together.get(p, set()) & b for p in a):
            a |= b
            members.update(dict.fromkeys(b, a))
    return {p: min(m, key=lambda q: (-widths[q], q)) for p, m in members.items()}


_PLAIN_KEY = re.compile(r"[A-Za-z0-9_ -]+")


def _read(value: Column, keys: list[str], read_as: str) -> Column:
    """The leaf at ``keys``; keys that a variant path can't express are looked up in a map."""
    for i, key in enumerate(keys):
        if not _PLAIN_KEY.fullmatch(key):
            inner = F.try_variant_get(value, "$" + "".join(f"['{k}']" for k in keys[:i]), "map<string,variant>")[key]
            return _read(inner, keys[i + 1 :], read_as)
    return F.try_variant_get(value, "$" + "".join(f"['{k}']" for k in keys), read_as)


def read_as(types: set[str]) -> str:
    """The column type that holds all values of these JSON types (of any message, not of most)."""
    sorts = {t for t in types if not t.startswith(("num1", "float"))}
    if sorts == {"number"}:
        if "float" in types:  # long integers among fractions would lose digits as double
            return "variant" if any(t.startswith("num1") for t in types) else "double"
        return "decimal(38,0)" if "num19" in types else "bigint"
    if sorts == {"array"}:
        return "array<variant>"
    return next(iter(sorts)) if len(sorts) == 1 else "string"


class Projection:
    """The scripts compiled: a map from path to column for each file, and the type of each column."""

    def __init__(self, fields: dict[str, list[tuple[str, bool]]], types: dict[str, str], forms: dict[str, list[list[str]]], maps: DataFrame | None):
        self.fields, self.types, self.forms, self.maps = fields, types, forms, maps

    @classmethod
    def compile(cls, schemas: DataFrame, changes: DataFrame) -> Projection:
        """Each file's map follows from the scripts of its stream up to it: ``changes`` of keys, not of properties.

        The columns of different streams are the same where their paths are, or are linked by a
        rename in any stream and never stand in one file (:func:`path_groups`).
        """
        changes = materialize(changes.drop("src"), workspace(schemas.sparkSession, "changes"))
        rows = schemas.where("word is null").select("source_file", "path", F.map_keys("types").alias("types"), F.map_keys("kinds").alias("kinds"), "forms")
        rows = rows.withColumn("stream", stream_of(F.col("source_file")))
        files = rows.select("stream", "source_file").distinct()
        first = files.groupBy("stream").agg(F.min("source_file").alias("source_file"))
        start = rows.join(first, ["stream", "source_file"]).select("stream", "source_file", F.col("path").alias("field"), F.lit("added").alias("change"), F.lit("").alias("new_field"))
        scripts = changes.where("change <> 'retyped'").withColumn("stream", stream_of(F.col("source_file"))).unionByName(start)
        # a group is the scripts of one stream, never its messages
        changed = scripts.groupBy("stream").applyInPandas(_maps_of_stream(path_groups(schemas, changes)), _MAP)
        order = Window.partitionBy("stream").orderBy("source_file")
        maps = files.join(changed, "source_file", "left").select("source_file", F.last("layout", ignorenulls=True).over(order).alias("layout"))
        maps = materialize(maps, workspace(schemas.sparkSession, "layouts"))
        forms: dict[str, list[list[str]]] = {}
        for r in rows.select("path", F.explode(F.map_keys("forms")).alias("form")).distinct().orderBy("form").collect():
            forms.setdefault(r.path, []).append(json.loads(r.form))
        sorts = F.array_distinct(F.flatten(F.collect_set(F.concat("types", F.filter("kinds", lambda k: k.rlike("^num1[6-9]$"))))))
        pairs = rows.join(maps, "source_file").groupBy("path", F.col("layout")[F.col("path")].alias("name")).agg(sorts.alias("types")).collect()
        columns = Counter(r.path for r in pairs)
        fields: dict[str, list[tuple[str, bool]]] = {}
        kinds: dict[str, set[str]] = {}
        for r in sorted(pairs, key=lambda r: (r.name, r.path)):
            fields.setdefault(r.name, []).append((r.path, columns[r.path] > 1))
            kinds.setdefault(r.name, set()).update(r.types)
        return cls(fields, {name: read_as(k) for name, k in kinds.items()}, forms, maps)

    def apply(self, df: DataFrame, message: str = "message", file: str = "source_file") -> DataFrame:
        """``df`` with one struct ``record`` of all fields; null for unreadable messages."""
        if not self.fields:
            return df.withColumn("record", F.lit(None).cast("struct<>"))
        names: dict[str, str] = {}
        for field in sorted(self.fields, key=lambda f: ("." in f, f)):
            name = field.replace(".", "_")
            while name.lower() in names:
                name += "_"
            names[name.lower()] = field
        out = {field: field.replace(".", "_") + "_" * (len(low) - len(field)) for low, field in names.items()}
        v = F.col("_v")

        def read(name: str, path: str, ambiguous: bool) -> Column:
            value = F.coalesce(*(_read(v, keys, self.types[name]) for keys in self.forms.get(path, [[path]])))
            return F.when(F.col("_layout")[path] == name, value) if ambiguous else value

        columns = [F.coalesce(*(read(name, *p) for p in paths)).alias(out[name]) for name, paths in self.fields.items()]
        maps = self.maps.select(F.col("source_file").alias("_file"), F.col("layout").alias("_layout"))
        if any(ambiguous for paths in self.fields.values() for _, ambiguous in paths):
            df = df.join(maps, df[file] == maps["_file"], "left")
        else:  # every path has one column in all files
            df = df.withColumns({"_file": F.lit(None), "_layout": F.lit(None)})
        df = df.withColumn("_v", F.try_parse_json(F.col(message)))
        return df.withColumn("record", F.when(v.isNotNull(), F.struct(*columns))).drop("_v", "_file", "_layout")
