"""Semi-structured log lines into fields, by longest-common-subsequence template mining.

1. Every line is tokenised once; tokens of a known form (times, addresses, levels, names, quoted
   texts, bracket groups, key=value) are reduced to their type, other words keep their text
   with digits masked. The distinct sequences are counted over all lines.
2. Sequences are clustered: one joins the template with which it has the longest common
   subsequence, if that covers half of both; what differs becomes a slot, of one token or of
   any length, which keeps the types it held. Templates of chunks are merged level by level.
3. Slots are classified by their types over the cluster: they decide whether the template's lines
   start an entry and where level, component and request stand. No merge moves a field.
4. All lines are parsed by their template; lines that start no entry join the entry before,
   found by a two-level scan over blocks of lines, so no file has to fit into one task.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade.operators.skew import attach
from palisade.storage import materialize, workspace

# Fixed value: the access pattern of the web-server format (Java regular expression).
ACCESS_PATTERN = r'^(\S+) (\S+) (\S+) \[(.+?)] "([^"]+)" (\d{3}) (\d+|-) "([^"]+)" "([^"]+)"?$'
# Severities of syslog priority numbers, in order.
SEVERITIES = ["EMERG", "ALERT", "CRIT", "ERR", "WARNING", "NOTICE", "INFO", "DEBUG"]
# Level words, HTTP methods, and the keys under which programs put a field.
LEVELS = "trace|debug|info|information|notice|warn|warning|error|err|crit|critical|alert|emerg|emergency|fatal|severe|panic"
METHODS = "GET|HEAD|POST|PUT|DELETE|OPTIONS|PATCH|TRACE|CONNECT|PROPFIND"
_TYPE_METHODS = METHODS.replace("|TRACE", "")  # alone, TRACE is a level
TIME_KEYS = {"ts", "time", "timestamp", "@timestamp", "date", "datetime", "t"}
LEVEL_KEYS = {"level", "lvl", "severity", "loglevel", "log_level"}
COMPONENT_KEYS = {"component", "module", "logger", "program", "app", "source", "comp"}
REQUEST_KEYS = {"request", "req"}

_TOKEN = re.compile(
    r"(?P<pri><\d{1,3}>)(?P<ver>\d{1,2}(?=\s))?"
    r"|(?P<kv>[A-Za-z_@][\w.@-]*)=(?P<kvv>\"(?:[^\"\\]|\\.)*\"|\S*)"
    r"|(?P<q>\"(?:[^\"\\]|\\.)*\"?)"
    r"|(?P<br>\[[^\]\[]*\])(?=[\s,:]|$)"
    r"|(?P<w>:(?=\s*\")|\S+)"
)
_TYPES = [
    ("<time>", re.compile(r"\d{4}-\d\d-\d\dT\d\d:\d\d(?::\d\d(?:[.,]\d+)?)?(?:Z|[+-]\d\d:?\d\d)?[,:]?$")),
    ("<date>", re.compile(r"(?:\d{4}[-/]\d\d[-/]\d\d|\d\d[-/.]\d\d[-/.]\d{4}),?$")),
    ("<clock>", re.compile(r"\d{1,2}:\d\d:\d\d(?:[.,]\d+)?(?:Z|[+-]\d\d:?\d\d)?$")),
    ("<month>", re.compile(r"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)$")),
    ("<ip>", re.compile(r"(?:\d{1,3}(?:\.\d{1,3}){3}|(?=[0-9A-Fa-f]*:[0-9A-Fa-f]*:)[0-9A-Fa-f:]{3,39})$")),
    ("<hostport>", re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+:\d{1,5}$")),
    ("<num>", re.compile(r"[+-]?\d+(?:\.\d+)?[,;:%)]?$")),
    ("<method>", re.compile(rf"(?:{_TYPE_METHODS})$")),
    ("<level>", re.compile(rf"(?:{LEVELS})$", re.I)),
    ("<tag>", re.compile(r"[A-Za-z_][\w./-]*\[\d+\]:$")),
    ("<path>", re.compile(r"/\S*$")),
    ("<name:>", re.compile(r"[A-Za-z_][\w.-]*:$")),
    ("<name>", re.compile(r"[A-Za-z_]\w*(?:\.[A-Za-z_$][\w$]*)+$")),
]
_DIGITS = re.compile(r"\d+")
_MODULE_LEVEL = re.compile(rf"\[([\w.-]*):({LEVELS}|trace[1-8])\]$", re.I)
_BARE_LEVEL = re.compile(rf"\[({LEVELS}|trace[1-8])\]$", re.I)
_REQUEST = re.compile(rf'"(?:{METHODS}) \S', re.I)


SLOT, WORD = "*", "?"  # in a template: any run of tokens, exactly one token


def tokenize(line: str) -> list[tuple[str, str]]:
    """(type, text) tokens of a line. Indented lines begin with an ``<indent>`` token."""
    out: list[tuple[str, str]] = []
    if line[:1] in ("{", "[") and line.rstrip()[-1:] in ("}", "]"):
        try:
            doc = json.loads(line)
        except (ValueError, RecursionError):
            doc = None
        if isinstance(doc, dict):
            return [("<json>", ""), *((f"<key>{k}", v if isinstance(v, str) else "" if v is None else json.dumps(v)) for k, v in doc.items())]
    if line[:1].isspace():
        out.append(("<indent>", line[: len(line) - len(line.lstrip())]))
    for m in _TOKEN.finditer(line):
        if m["pri"]:
            out.append(("<pri>", m["pri"][1:-1]))
            if m["ver"]:
                out.append(("<ver>", m["ver"]))
        elif m["kv"]:
            value = m["kvv"]
            out.append((f"<kv>{m['kv']}", value[1:-1] if value[:1] == '"' and value[-1:] == '"' and len(value) > 1 else value))
        elif m["q"]:
            out.append(("<request>" if _REQUEST.match(m["q"]) else "<quoted>", m["q"]))
        elif m["br"]:
            b = m["br"]
            first = not out  # only a bracket that opens the line is asked for a time
            kind = "<[module:level]>" if _MODULE_LEVEL.match(b) else "<[level]>" if _BARE_LEVEL.match(b) else "<[time]>" if first and re.search(r"\d:\d\d|\d{9}|\d{4}-\d\d|\d{8}T", b) else "<[...]>"
            out.append((kind, b))
        else:
            w = m["w"]
            kind = next((name for name, pattern in _TYPES if pattern.match(w)), None)
            out.append((kind or ("\\" if w in (SLOT, WORD) else "") + _DIGITS.sub("0", w), w))
    return out


def _typed(t: str) -> bool:
    return t[:1] == "<" and len(t) > 2


def _constant(t: str) -> bool:
    return t not in (SLOT, WORD)


def head_form(types: list[str]) -> str:
    """The first three tokens, words of any text being alike: templates differ by it at least."""
    return " ".join(t if _typed(t) or not t[:1].isalnum() else "w" for t in types[:3]) if types and _typed(types[0]) else "w"


def _masks(types: list[str]) -> dict[str, int]:
    """Where each token stands, as bits from the first position up; slots stand nowhere."""
    masks: dict[str, int] = {}
    for i, t in enumerate(types):
        if _constant(t):
            masks[t] = masks.get(t, 0) | 1 << i
    return masks


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Index pairs of one longest common subsequence; slots match nothing.

    Equal beginnings and ends are paired first. Between them a row of the table of lengths, one
    for each token of ``b``, is an integer: its bits tell which tokens of ``a`` add nothing. Some
    rows are kept and those between computed again on the way back, so that lines of any length
    are paired by the same rule, in memory of the length times its square root in bits.
    """
    low = min(len(a), len(b))
    start = 0
    while start < low and a[start] == b[start] and _constant(a[start]):
        start += 1
    stop = 0
    while stop < low - start and a[-1 - stop] == b[-1 - stop] and _constant(a[-1 - stop]):
        stop += 1
    x, y = a[start : len(a) - stop], b[start : len(b) - stop]
    pairs = [(k, k) for k in range(start)]
    masks = _masks(x[::-1])
    every = math.isqrt(len(y)) + 1
    full = row = (1 << len(x)) - 1
    kept = {len(y): row}
    for j in range(len(y) - 1, -1, -1):
        hit = row & masks.get(y[j], 0)
        row = ((row + hit) | (row - hit)) & full
        if j % every == 0:
            kept[j] = row
    i = 0
    for j in range(0, len(y), every):
        end = min(j + every, len(y))
        rows = [kept[end]]
        for t in reversed(y[j:end]):
            hit = rows[-1] & masks.get(t, 0)
            rows.append(((rows[-1] + hit) | (rows[-1] - hit)) & full)
        while i < len(x) and j < end:
            if x[i] == y[j] and _constant(x[i]):
                pairs.append((start + i, start + j))
                i, j = i + 1, j + 1
            elif rows[end - j] >> (len(x) - 1 - i) & 1:
                i += 1
            else:
                j += 1
    return pairs + [(len(a) - k, len(b) - k) for k in range(stop, 0, -1)]


def common_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, bit by bit: linear in the longer sequence."""
    if len(a) > len(b):
        a, b = b, a
    masks = _masks(a)
    full = row = (1 << len(a)) - 1
    for t in b:
        hit = row & masks.get(t, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


class Template:
    """A cluster of token sequences: ``types`` has what all have in common, and slots.

    ``seen`` counts, for each ``WORD`` slot, the types of the tokens that stood there, words of
    any text as ``w``. ``roles`` is what the slots say about the cluster's lines.
    """

    __slots__ = ("types", "seen", "n", "roles")

    def __init__(self, types: list[str], seen: dict[int, dict[str, int]] | None = None, n: int = 1):
        self.types, self.seen, self.n = types, seen or {}, n
        self.roles = roles(types, self.seen)

    def profile(self, i: int) -> dict[str, int]:
        """Types of the tokens at position ``i``, with their counts."""
        t = self.types[i]
        return self.seen[i] if t == WORD else {t if _typed(t) else "w": self.n}

    def merged(self, other: Template) -> Template | None:
        """The template of both clusters; None where a field of one would be lost or moved.

        Every field of the result must stand, in either member, on that member's own field or on
        a token that is no field there. So a cluster may give a field to a line that shows none by
        itself, but no line gets a field from another token than its own.
        """
        a, b = self.types, other.types
        types: list[str] = []
        seen: dict[int, dict[str, int]] = {}
        at_a: dict[int, int] = {}
        at_b: dict[int, int] = {}
        i = j = 0
        for p, q in [*common(a, b), (len(a), len(b))]:
            if p - i == q - j and SLOT not in a[i:p] and SLOT not in b[j:q]:  # as many tokens in both: a slot for each
                for k in range(p - i):
                    both = dict(self.profile(i + k))
                    for t, c in other.profile(j + k).items():
                        both[t] = both.get(t, 0) + c
                    at_a[len(types)], at_b[len(types)], seen[len(types)] = i + k, j + k, both
                    types.append(WORD)
            elif types[-1:] != [SLOT]:
                types.append(SLOT)
            if p < len(a):
                at_a[len(types)], at_b[len(types)] = p, q
                types.append(a[p])
            i, j = p + 1, q + 1
        out = Template(types, seen, self.n + other.n)
        for member, place in ((self, at_a), (other, at_b)):
            if member.roles["kind"] != out.roles["kind"]:
                return None
            fields = {k: v for k, v in out.roles.items() if k != "kind"}
            own = {k: v for k, v in member.roles.items() if k != "kind"}
            if own.keys() - fields.keys() or any(place.get(v) != own[k] for k, v in fields.items() if k in own):
                return None
        return out


class Templates:
    """Templates of one head form; ``add`` merges a cluster into the closest that takes it.

    Two are close if their longest common subsequence covers ``share`` of the longer.
    """

    def __init__(self, share: float = 0.5):
        self.share, self.items = share, []

    def add(self, new: Template) -> int:
        """Index of the template that the cluster is part of from now on."""
        own = sum(map(_constant, new.types))
        near = []
        for i, t in enumerate(self.items):
            size = sum(map(_constant, t.types))
            need = self.share * max(own, size)
            if min(own, size) >= need and (n := common_length(t.types, new.types)) >= need:
                near.append((-n, i))
        for _, i in sorted(near):
            both = self.items[i].merged(new)
            if both is not None:
                self.items[i] = both
                return i
        self.items.append(new)
        return len(self.items) - 1


_SEPARATORS = {"-", "--", "---", ":", "|", "::"}
_SURE = 0.9  # of a slot's tokens that must be of a type for the slot to be of it


def roles(types: list[str], seen: dict[int, dict[str, int]] | None = None) -> dict[str, int | str]:
    """Classifies a template by the types of its slots: what starts an entry, and which slots are fields.

    Keys: ``kind`` (``entry``, ``open`` for a multi-line object, ``member`` for one of its keys,
    ``more`` for any other line that starts no entry) and positions ``pri``, ``level``,
    ``component``, ``both`` (a module:level bracket), ``request``, ``method``, ``path``, and of a
    member ``key`` and ``value``. Fields stand in the head, which ends with the first slot of any
    length or at the first word of running text; only named values are found by name anywhere.
    """
    seen = seen or {}
    n = len(types)

    def is_(i: int | None, *kinds: str) -> bool:
        """Whether the slot at ``i`` holds one of these types."""
        if i is None or not 0 <= i < n:
            return False
        if types[i] != WORD:
            return types[i] in kinds
        counts = seen.get(i, {})
        return sum(c for t, c in counts.items() if t in kinds) >= _SURE * sum(counts.values()) > 0

    def single(i: int) -> bool:
        return i < n and types[i] != SLOT

    def entry(**found: int | None) -> dict[str, int | str]:
        return {"kind": "entry"} | {k: v for k, v in found.items() if v is not None}

    more: dict[str, int | str] = {"kind": "more"}
    if not types:
        return more
    first = types[0]
    if types == ["{"]:
        return {"kind": "open"}
    if types[:3] == ["<indent>", "<quoted>", ":"]:
        return {"kind": "member", "key": 1, "value": 3} if is_(3, "<quoted>") else more
    if first == "<json>" or first.startswith("<kv>"):
        keyed: dict[str, int] = {}
        for i, t in enumerate(types):
            if t.startswith(("<kv>", "<key>")):
                keyed.setdefault(t[t.index(">") + 1 :].lower(), i)
        pick = lambda names: next((i for k, i in keyed.items() if k in names), None)
        if pick(TIME_KEYS) is None and pick(LEVEL_KEYS) is None:
            return more
        return entry(level=pick(LEVEL_KEYS), component=pick(COMPONENT_KEYS), request=pick(REQUEST_KEYS))

    def tag(i: int) -> int | None:
        """The program after a time: at ``i`` or, after a host, next to it."""
        return next((k for k in (i, i + 1) if single(i) and is_(k, "<tag>", "<name:>")), None)

    if first == "<pri>":
        if is_(1, "<ver>"):  # version, time, host, program
            return entry(pri=0, component=4 if single(2) and single(3) and single(4) else None)
        if is_(1, "<month>") and is_(2, "<num>") and is_(3, "<clock>"):
            return entry(pri=0, component=tag(4))
        return entry(pri=0, component=tag(2 if is_(1, "<time>") else 1))
    if first == "<month>" and is_(1, "<num>") and is_(2, "<clock>"):
        return entry(component=tag(3))
    if first in ("<ip>", "<hostport>"):
        bracket = next((i for i in range(1, min(6, n)) if is_(i, "<[...]>")), None)
        if bracket is None or not all(single(i) for i in range(bracket)):
            return more
        return entry(request=bracket + 1 if is_(bracket + 1, "<request>", "<quoted>") else None)
    if first == "<[level]>" or first == "<level>" and is_(1, "<time>", "<date>", "<[time]>"):
        return entry(level=0)
    if first in ("<time>", "<[time]>"):
        clock = 1
    elif first == "<date>" and is_(1, "<clock>"):
        clock = 2
    else:
        return more
    if is_(clock, "<ip>") and is_(clock + 1, "<method>", "<level>") and is_(clock + 2, "<path>"):
        return entry(method=clock + 1, path=clock + 2)
    level = None
    for i in range(clock, n):
        if is_(i, "<[module:level]>"):
            return entry(both=i)
        if is_(i, "<level>", "<[level]>"):
            level = i
            break
        between = types[i - 1] in _SEPARATORS and i + 1 < n and types[i + 1] in _SEPARATORS
        if not (types[i] in _SEPARATORS or between and single(i) or is_(i, "<[...]>", "<num>", "<name>", "<ip>", "<hostport>")):
            break
    if level is None:
        return entry()
    component = None
    if is_(level, "<level>"):
        if is_(level + 1, "<name:>", "<tag>"):  # LEVEL name: message
            component = level + 1
        elif level == clock + 3 and types[clock] == types[clock + 2] and types[clock] in _SEPARATORS:  # - name - LEVEL -
            component = clock + 1
        else:  # LEVEL [thread] name -
            i = level + 1
            while i < n and (types[i] in _SEPARATORS or is_(i, "<[...]>", "<num>")):
                i += 1
            if single(i) and i + 1 < n and types[i + 1] in _SEPARATORS:
                component = i
    return entry(level=level, component=component)


def places(template: Template, types: list[str]) -> dict[str, int | str] | None:
    """Where a line of the template has its fields, None where it does not fit.

    Up to the template's first free slot tokens correspond one to one; a named value beyond it
    is found by its name.
    """
    stop = template.types.index(SLOT) if SLOT in template.types else len(template.types)
    out: dict[str, int | str] = {}
    for k, v in template.roles.items():
        if k != "kind" and v >= stop:
            if template.types[v] not in types:
                return None
            v = types.index(template.types[v])
        elif k != "kind" and v >= len(types):
            return None
        out[k] = v
    return out


_TOKENS = "log_file string, line_no bigint, seq bigint, form string, types array<string>, texts array<string>"
_SEEN = 100_000  # sequences of which a task remembers that it has passed them on


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: set[int] = set()
    for pdf in batches:
        rows = []
        for file, no, line in zip(pdf["log_file"], pdf["line_no"], pdf["value"]):
            tokens = tokenize(line) if line else []
            if not tokens:
                rows.append((file, no, None, None, None, None))
                continue
            types = [t for t, _ in tokens]
            seq = xxhash.xxh3_64_intdigest("\x1f".join(types)) - (1 << 63)
            first = (None, None) if seq in known else (head_form(types), types)
            rows.append((file, no, seq, *first, [x for _, x in tokens]))
            known.add(seq)
        if len(known) > _SEEN:
            known.clear()
        yield pd.DataFrame(rows, columns=["log_file", "line_no", "seq", "form", "types", "texts"])


def tokenize_lines(lines: DataFrame) -> DataFrame:
    """(log_file, line_no, value) → (log_file, line_no, seq, form, types, texts).

    ``seq`` identifies the sequence of token types, null for null, empty and blank lines;
    ``form`` (:func:`head_form`) and ``types`` come with the first line of a sequence in each
    task, ``texts`` with each.
    """
    return lines.select("log_file", "line_no", "value").mapInPandas(_tokens, _TOKENS)


CHUNK = 1000  # sequences or templates that one task clusters
_CLUSTERED = "id bigint, form string, template bigint, types array<string>, seen string, n bigint"


def _cluster(pdf: pd.DataFrame) -> pd.DataFrame:
    """Clusters of one chunk, frequent ones first: a row a member, the template with its first one."""
    found = Templates()
    member = {}
    for r in sorted(pdf.itertuples(), key=lambda r: (-r.n, list(r.types))):
        seen = {int(k): v for k, v in json.loads(r.seen).items()} if r.seen else None
        member[r.id] = found.add(Template(list(r.types), seen, int(r.n)))
    form = pdf["form"].iloc[0]
    ids = [xxhash.xxh3_64_intdigest("\x1f".join([form, *t.types, json.dumps(t.seen, sort_keys=True)])) - (1 << 63) for t in found.items]
    rows, given = [], set()
    for i, k in member.items():
        t = found.items[k]
        rows.append((i, form, ids[k], *((t.types, json.dumps(t.seen), t.n) if k not in given else (None, None, None))))
        given.add(k)
    out = pd.DataFrame(rows, columns=["id", "form", "template", "types", "seen", "n"])
    return out.astype({"n": "Int64"})


_FIELDS = ["pri", "level", "component", "both", "request", "method", "path", "key", "value"]
_ROLES = "seq bigint, n bigint, kind string, " + ", ".join(f"at_{k} int" for k in _FIELDS)


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[int, Template] = {}
    for pdf in batches:
        rows = []
        for r in pdf.itertuples():
            t = known.get(r.template)
            if t is None:
                t = known[r.template] = Template(list(r.pattern), {int(k): v for k, v in json.loads(r.seen).items()})
            p = places(t, list(r.types))
            if p is not None:
                rows.append((r.seq, r.n, p["kind"], *(p.get(k) for k in _FIELDS)))
        if len(known) > _SEEN:
            known.clear()
        out = pd.DataFrame(rows, columns=["seq", "n", "kind", *(f"at_{k}" for k in _FIELDS)])
        yield out.astype({f"at_{k}": "Int32" for k in _FIELDS})


def mine_templates(tokens: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows of :func:`tokenize_lines` → (seq, n, kind, at_pri, at_level, ...): what each sequence's template says.

    Distinct sequences are counted over all lines. Those of one head form are cut into chunks
    of about ``chunk`` by their own hash, never by the tasks they come from, and clustered; the
    chunks' templates are clustered again, until a form is one chunk or no more merge. So the
    templates depend on the lines alone, however they are spread.
    """
    spark = tokens.sparkSession
    sequences = tokens.where("types is not null").groupBy("seq").agg(F.first("form").alias("form"), F.first("types").alias("types"))
    counts = tokens.where("seq is not null").groupBy("seq").agg(F.count(F.lit(1)).alias("n"))
    sequences = materialize(sequences.join(counts, "seq"), workspace(spark, "sequences"))
    level = sequences.select(F.col("seq").alias("id"), "form", "types", F.lit(None).cast("string").alias("seen"), "n")
    members, total, last = None, level.count(), None
    while total and (last is None or total < 0.95 * last):
        sizes = level.groupBy("form").agg(F.count(F.lit(1)).alias("size")).withColumn("rows", F.col("size"))
        cut = attach(level, sizes, ["form"], "rows", total, F.col("id"))
        cut = cut.withColumn("chunk", F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / F.lit(chunk))))
        got = cut.groupBy("form", "chunk").applyInPandas(_cluster, _CLUSTERED)
        got = materialize(got, workspace(spark, "templates"))
        step = got.select("id", "template")
        members = step if members is None else members.join(step.select(F.col("id").alias("template"), F.col("template").alias("next")), "template").select("id", F.col("next").alias("template"))
        level = got.where("types is not null").select(F.col("template").alias("id"), "form", "types", "seen", "n")
        largest = cut.agg(F.max("size")).first()[0]
        last, total = total, level.count()
        if largest <= chunk:
            break
    if members is None:
        return spark.createDataFrame([], _ROLES)
    found = sequences.select(F.col("seq").alias("id"), "types", "n").join(members, "id")
    patterns = level.select(F.col("id").alias("template"), F.col("types").alias("pattern"), "seen")
    found = found.join(patterns, "template").select(F.col("id").alias("seq"), "types", "n", "template", "pattern", "seen")
    return found.mapInPandas(_places, _ROLES)


def parse_lines(tokens: DataFrame, templates: DataFrame) -> DataFrame:
    """Rows of :func:`tokenize_lines` → each line's kind and fields, by the mined templates.

    A line takes its fields from the tokens that stand on its template's slots; one without a
    template starts no entry. A sequence that very many lines share is spread over tasks.
    """
    templates = materialize(templates, workspace(tokens.sparkSession, "line-roles"))
    total = templates.agg(F.sum("n")).first()[0] or 0
    lines = tokens.select("log_file", "line_no", "seq", "texts")
    rows = attach(lines.where("seq is not null"), templates, ["seq"], "n", total, F.col("line_no"))
    text = lambda k: F.get("texts", F.col(f"at_{k}"))
    number = text("pri").try_cast("int") % len(SEVERITIES)
    bare = F.regexp_replace(text("both"), r"^\[|\]$", "")
    words = F.split(F.regexp_replace(text("request"), r'^"+|"+$', ""), " ")
    asked = (F.size(words) >= 2) & F.get(words, F.lit(0)).rlike(r"^\w+$") & (F.get(words, F.lit(1)) != "")
    key = F.lower(F.regexp_replace(text("key"), r'^"|"$', ""))
    value = F.regexp_replace(text("value"), r'^"|"$', "")
    name = F.regexp_replace(text("component"), r"(?:\[\d+\])?:?$", "")
    level = F.coalesce(
        F.regexp_replace(text("level"), r"^[\[\]]+|[\[\]]+$", ""), F.regexp_extract(bare, r"^(.*):([^:]*)$", 2), F.get(F.array(*map(F.lit, SEVERITIES)), number),
        F.when(key.isin(*LEVEL_KEYS), value), F.lit(""),
    )
    component = F.coalesce(F.when(name == "-", "").otherwise(name), F.regexp_extract(bare, r"^(.*):([^:]*)$", 1), F.when(key.isin(*COMPONENT_KEYS), value), F.lit(""))
    out = rows.select(
        "log_file", "line_no", "kind", F.upper(level).alias("level"), component.alias("component"),
        F.coalesce(text("method"), F.when(asked, F.get(words, F.lit(0))), F.lit("")).alias("method"),
        F.coalesce(text("path"), F.when(asked, F.get(words, F.lit(1))), F.lit("")).alias("path"),
        F.when(F.col("kind") == "member", F.length(F.get("texts", F.lit(0)))).otherwise(0).alias("indent"),
    )
    blank = lines.where("seq is null").select("log_file", "line_no", F.lit("more").alias("kind"), *(F.lit("").alias(c) for c in ("level", "component", "method", "path")), F.lit(0).alias("indent"))
    return out.unionByName(blank)


BLOCK = 4096


def entries(parsed: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds ``first_line``: the start of each line's entry, null before the first entry of a file.

    A running maximum in two levels: within blocks of ``block`` lines, then over one row a block.
    """
    rows = parsed.withColumn("_b", F.floor(F.col("line_no") / F.lit(block)))
    start = F.when(F.col("kind").isin("entry", "open"), F.col("line_no"))
    within = Window.partitionBy("log_file", "_b").orderBy("line_no").rangeBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_start", start)
    carry = rows.groupBy("log_file", "_b").agg(F.max("_start").alias("_last"))
    before = Window.partitionBy("log_file").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = carry.select("log_file", "_b", F.max("_last").over(before).alias("_carry"))
    rows = rows.withColumn("_own", F.max("_start").over(within)).join(carry, ["log_file", "_b"])
    return rows.withColumn("first_line", F.coalesce("_own", "_carry")).drop("_b", "_start", "_own", "_carry")


def log_entries(lines: DataFrame, parsed: DataFrame) -> DataFrame:
    """One row an entry: log_file, first_line, last_line, level, component, method, path, access.

    ``access`` tells that the entry's first line matches the access pattern. Repeated rows of
    a line count once; null and blank lines continue the entry before; lines before the first
    entry of a file belong to none and are left out.
    """
    access = lines.where(F.col("value").rlike(ACCESS_PATTERN)).select("log_file", "line_no").distinct().withColumn("access", F.lit(True))
    rows = entries(parsed).where("first_line is not null")
    is_open = F.max(F.when(F.col("kind") == "open", True))
    head = F.col("line_no") == F.col("first_line")
    key_rows = F.when(~head, F.struct("indent", "line_no"))
    out = rows.groupBy("log_file", "first_line").agg(
        F.max("line_no").alias("last_line"),
        *(F.max(F.when(head, F.col(c))).alias(f"_{c}") for c in ("level", "component", "method", "path")),
        F.min_by("level", F.when(F.col("level") != "", key_rows)).alias("_body_level"),
        F.min_by("component", F.when(F.col("component") != "", key_rows)).alias("_body_component"),
        is_open.alias("_open"),
    )
    body = lambda c: F.coalesce(F.when(F.col("_open"), F.col(f"_body_{c}")), F.col(f"_{c}"), F.lit("")).alias(c)
    out = out.select("log_file", "first_line", "last_line", body("level"), body("component"), F.coalesce("_method", F.lit("")).alias("method"), F.coalesce("_path", F.lit("")).alias("path"))
    joined = out.join(access, (out.log_file == access.log_file) & (out.first_line == access.line_no), "left")
    return joined.select(out["*"], F.coalesce("access", F.lit(False)).alias("access"))
