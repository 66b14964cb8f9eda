"""The operators for training text against brute force and on hard inputs."""

import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palisade.llm import encoding, history, leakage
from palisade.llm import sentences as sentence_module
from palisade.llm.sentences import sentences, split_sentences
from palisade.storage import workspace

# -- 3 history ----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "kind,a,b",
    [
        ("ipv4", " 240[.]1.100.35/32", "240.1.100.35"), ("ipv6", "2001:0DB8:00AB:0000:0000:0000:0005:F00D", "2001:db8:ab::5:f00d/128"),
        ("domain", "BÄCKER.example.", "xn--bcker-gra.example"), ("hostname", "mail(.)X[dot]test", "MAIL.x.test."),
        ("url", "hXXps[:]//Dra[.]example:443/tmp/../%50anel/a%2fb?x=1#top", "https://dra.example/Panel/a%2Fb?x=1"), ("url", "http://h.example", "HTTP://H.example:80/"),
        ("filehash-md5", "AB01 ", "ab01"), ("filehash-tlsh", "t1ab", "T1AB"),
    ],
)
def test_same_indicator(kind, a, b):
    assert history.canonical(kind, a) == history.canonical(kind, b)


@pytest.mark.parametrize(
    "kind,a,b",
    [
        ("url", "http://h.example/a", "https://h.example/a"), ("url", "http://h.example/A", "http://h.example/a"), ("url", "http://h.example/a/", "http://h.example/a"),
        ("url", "http://h.example:8080/", "http://h.example/"), ("url", "http://h.example/?a=1&b=2", "http://h.example/?b=2&a=1"), ("ipv4", "10.0.0.0/24", "10.0.0.0"),
        ("filehash-ssdeep", "3:aB:c", "3:AB:c"),
    ],
)
def test_other_indicator(kind, a, b):
    assert history.canonical(kind, a) != history.canonical(kind, b)


def test_canonical_never_fails():
    for value in ("", " ", "[.]", "http://", "xn--ä", "xn--99999999", "::1%x", "http://[::1", "a" * 100_000, "http://@:99999/..", "%zz", "。"):
        for kind in ("ipv4", "domain", "url", "filehash-md5", "filehash-ssdeep", "", "mutex"):
            assert isinstance(history.canonical(kind, value), str)


def test_prefixes_widen_until_the_recall_target():
    assert history.prefix_depth(1.0) == history.sure_depth(16) == 3 and history.prefix_depth(0.0) == history.LONGEST
    assert history.recall_of_depth(3) == 1.0 > history.recall_of_depth(4) > history.recall_of_depth(6)
    assert history.prefix_depth(history.recall_of_depth(4)) == 4 and history.prefix_depth(0.9999) == 3
    for n in range(5, 17):  # the guarantee, by trying all placements
        free = [max(b - a - 1 for a, b in zip([-1, *p], [*p, n])) for p in itertools.combinations(range(n), 4)]
        assert min(free) == max(0, history.sure_depth(n))


def test_recall_of_each_depth(spark):
    """Measured against brute force: the default finds all, the longest prefix about what it promises."""
    rng = random.Random(4)
    kinds = history.FUZZY
    old = [(i, kinds[i % 2], "".join(rng.choice("0123456789ABCDEF") for _ in range(rng.choice((40, 70, 96))))) for i in range(60)]
    new = [(1000 + i, k, mutate(rng, v, rng.choice((2, 3, 4)))) for i, (_, k, v) in enumerate(old * 3)]
    for i, (_, k, v) in enumerate(old):  # edits spread so that no four segments in a row are whole
        q = len(v) // 16
        new.append((2000 + i, k, "".join("#" if j in (3 * q, 7 * q, 11 * q, 15 * q) else c for j, c in enumerate(v))))
    schema = "row_id bigint, kind string, value string"
    want = {b for _, b in history_by_force(old + new)}
    share = {}
    for recall in (1.0, 0.5):
        forest = history.HashForest(spark, workspace(spark, "f"), recall)
        forest.accept(spark.createDataFrame(old, schema))
        got = {r.row_id_b for r in forest.accept(spark.createDataFrame(new, schema)).collect()}
        assert got <= want
        share[forest.depth] = [sum(lo <= b < lo + 1000 for b in got) / sum(lo <= b < lo + 1000 for b in want) for lo in (1000, 2000)]
    assert share[3] == [1.0, 1.0] and share[4][0] >= 0.9 > share[4][1]


def test_a_small_batch_reads_little_of_a_large_history(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("0123456789ABCDEF") for _ in range(n))
    schema = "row_id bigint, kind string, value string"
    old = [(i, "domain", word(12)) for i in range(20_000)] + [(20_000 + i, "filehash-tlsh", word(70)) for i in range(10_000)]
    forest = history.HashForest(spark, workspace(spark, "f"), rows_per_file=100)
    forest.accept(spark.createDataFrame(old, schema))
    exact, runs = len(forest.exact.files), len(forest.runs.files)
    assert exact > 200 and runs > 1000
    read = {"exact": 0, "runs": 0}
    for name in read:
        store = getattr(forest, name)
        files = store.files_of
        store.files_of = lambda ranges, files=files, name=name: read.__setitem__(name, len(found := files(ranges))) or found
    batch = [(50_000, "domain", old[77][2]), (50_001, "filehash-tlsh", mutate(rng, old[25_000][2], 4)), (50_002, "domain", "new")]
    got = forest.accept(spark.createDataFrame(batch, schema)).collect()
    assert {tuple(r) for r in got} == {(77, 50_000), (25_000, 50_001)}
    assert 0 < read["exact"] < 0.1 * exact and 0 < read["runs"] < 0.1 * runs


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def history_by_force(rows):
    accepted, pairs = [], set()
    for row_id, kind, value in rows:
        same = lambda v: v == value or kind in history.FUZZY and distance(v, value) <= 4
        near = next((r for r, k, v in accepted if k == kind and same(v)), None)
        if near is None:
            accepted.append((row_id, kind, value))
        else:
            pairs.add((near, row_id))
    return pairs


def mutate(rng, value, n):
    out = list(value)
    for _ in range(n):
        i = rng.randrange(len(out) + 1)
        what = rng.randrange(3)
        if what == 0 or not out or i == len(out):
            out.insert(i, rng.choice("0123456789ABCDEF"))
        elif what == 1:
            out[i] = rng.choice("0123456789ABCDEF")
        else:
            del out[i]
    return "".join(out)


@pytest.mark.parametrize("seed", range(3))
def test_history_equals_greedy_search(spark, seed):
    rng = random.Random(seed)
    seeds = ["".join(rng.choice("0123456789ABCDEF") for _ in range(n)) for n in (70, 70, 71, 30, 12, 6, 4, 2, 1)]
    rows = []
    for i in range(160):
        kind = rng.choice(["filehash-tlsh", "filehash-tlsh", "filehash-ssdeep", "domain"])
        base = seeds[0] if rng.random() < 0.4 else rng.choice(seeds)
        rows.append((i, kind, mutate(rng, base, rng.choice((0, 0, 1, 3, 4, 5, 8))) or "A"))
    forest = history.HashForest(spark, workspace(spark, "f"))
    got = set()
    for part in (rows[:70], [], rows[70:110], rows[110:]):
        got |= {tuple(r) for r in forest.accept(spark.createDataFrame(part, "row_id bigint, kind string, value string")).collect()}
    assert got == history_by_force(rows)


def test_canonical_rows_edges(spark):
    rows = [(1, 0, "URL", None, "x"), (2, 0, " URL ", " ", "x"), (3, None, None, "a", "x"), (4, 0, "domain", "A.b.", "x")]
    df = spark.createDataFrame(rows, "row_id bigint, batch_no bigint, ioc_type string, ioc string, value string")
    assert {tuple(r) for r in history.canonical_rows(df).collect()} == {(3, None, "", "a"), (4, 0, "domain", "a.b")}


# -- 8 encoding ---------------------------------------------------------------------------------

TEXTS = ["", None, "Hello, world", "naïve — 日本語 🔥👍🏽", "<|endoftext|>", " \n\t ", "‮abc‬", "é" * 3, "long " * 40_000]


def test_encoding_round_trip(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string").withColumn("ids", F.lit("clash")).withColumn("_text", F.lit(1))
    enc = encoding.encode(df, offsets="at")
    assert enc.columns == ["doc_id", "text", "_text", "ids", "at"]
    rows = {r.doc_id: r for r in encoding.decode(enc, text="back").collect()}
    for i, text in enumerate(TEXTS):
        r = rows[i]
        assert r.back == (text or "") and (text or r.ids == []) and 50256 not in r.ids
        if text:  # offsets cover the text in order; a split character repeats its offsets
            assert r["at"][0].start == 0 and r["at"][-1].end == len(text)
            assert all(a.start <= b.start <= a.end for a, b in zip(r["at"], r["at"][1:]))


def test_encoding_of_nothing_and_cut_lists(spark):
    assert encoding.encode(spark.createDataFrame([], "text string")).count() == 0
    ids = encoding.encode(spark.createDataFrame([("🔥",)], "text string")).first().ids
    got = encoding.decode(spark.createDataFrame([(ids[:1],), (None,), ([],), ([10**9, -1],)], "ids array<int>")).collect()
    assert "�" in got[0].text and [r.text for r in got[1:]] == [None, "", ""]


def test_byte_table():
    table = encoding.byte_table()
    assert sorted(table.values()) == list(range(256))


# -- 9 leakage ----------------------------------------------------------------------------------


def leaks_by_force(docs, items):
    found = set()
    for item, lang, text in items:
        words = leakage.words_of(text)
        for doc, body in docs:
            if body is None or text is None:
                continue
            own = leakage.words_of(body)
            if lang == "zh":
                a, b, n = "".join(own), "".join(words), 20
                hit = any(b[i : i + n] in a for i in range(len(b) - n + 1))
            else:
                windows = {tuple(own[i : i + 10]) for i in range(len(own) - 9)}
                hit = any(tuple(words[i : i + 10]) in windows for i in range(len(words) - 9))
            if hit:
                found.add((doc, item))
    return found


@pytest.mark.parametrize("limit", [10**6, 3])
def test_leaks(spark, monkeypatch, limit):
    monkeypatch.setattr(leakage, "SHARED_LIMIT", limit)  # 3: the shingles stay distributed
    rng = random.Random(limit)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, "en", " ".join(rng.choice(vocabulary) for _ in range(18))) for i in range(6)]
    zh = "".join(chr(0x4E00 + rng.randrange(40)) for _ in range(45))
    items += [(100, "zh", zh), (101, "zh", None), (102, "en", "too short"), (103, None, items[0][2])]
    docs = [(0, None), (1, ""), (2, items[0][2]), (3, items[1][2].upper().replace(" ", " ​-- ")), (4, zh[5:24]), (5, "x" + zh[5:25] + "y"), (6, "，".join(zh[3:30]))]
    for d in range(10, 60):
        body = [rng.choice(vocabulary) for _ in range(40)]
        if d % 2:
            source = items[rng.randrange(6)][2].split()
            n = rng.choice((9, 10, 11, 18))
            at = rng.randrange(len(source) - n + 1)
            body[7:7] = source[at : at + n]
        docs.append((d, " ".join(body)))
    docs += docs[2:4]
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id bigint, text string, kind string, at int")
    got = leakage.find_leaks(df, spark.createDataFrame(items, "item_id bigint, lang string, text string"))
    assert {tuple(r) for r in got.collect()} == leaks_by_force(docs, items)


def test_windows_of_equal_ends(spark):
    letters = [chr(0x4E00 + i) for i in range(40)]
    a, b, x, y = ("".join(letters[i:j]) for i, j in ((0, 8), (8, 16), (16, 20), (20, 24)))
    items = [(1, "zh", a + x + b + "".join(letters[30:38]) + a + y + b)]
    docs = [(1, a + y + b), (2, a + x + b), *((d, a[1:] + x + b[:7]) for d in (3, 4, 5))]
    got = leakage.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, lang string, text string"))
    assert {tuple(r) for r in got.collect()} == leaks_by_force(docs, items) == {(1, 1), (2, 1)}


def test_no_leaks_in_nothing(spark):
    docs, items = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([], "item_id bigint, lang string, text string")
    assert leakage.find_leaks(docs, items).count() == 0
    assert leakage.find_leaks(docs, spark.createDataFrame([(1, "en", "a " * 30)], items.schema)).count() == 0


# -- 10 sentences -------------------------------------------------------------------------------

SPLIT = [
    "The St. Ulpos office sent No. 5.|The U.S. East collector db-1 lagged 9 seconds.|It is hosted in the U.S.|Version v9 fixes it, v. 7 does not.",
    "Ask team B.|They own db-05.|Stop!|Do not log in.|Why now?!|eth0 on x dropped 4 frames.|The scan ended at 9 p.m.|iptables on x-1 took 2 ms.|Next one.",
    'The analyst wrote "Isolate it. Then call us." before the shift ended.|"Is db-78 clean?" asked the lead.|The rule said: "Drop all from 10.1.1.1."|The end.',
    "(The full timeline is in App. 3.)|Logs were lost (see Sec. 10.71 of the runbook).|Score: 8.96.|We waited... and then it answered after 9 s.|It stayed quiet…|In Jan. 106 hosts came.",
    "Am 6. März kam es.|Dr. Timiti hat Nr. 2 geprüft, z. B. mit Apache, vgl. Abb. 3.|Der Rest usw.|„Wir trennen sofort. Danach prüfen wir.“, schrieb die Schicht.|Nun d. h. heute.",
    "Le trafic dépasse 33,33 Go !|Les copies, etc.|M. Eladowen, cf. p. 36, p. ex. ici.|« Coupez. Puis appelez. », dit la note.|Qui a ouvert ?",
    "«Отключите. Потом звоните.» — так сказано.|Входы, т. е. около 25,92 и т. д.|Учётная запись в 27 ч. утра, см. рис. 5 в отчёте.",
    "Ποιος άνοιξε το x στο db-73;|Ο αισθητήρας κατέγραψε 58, δηλ. 9,95.|Η διεύθυνση, βλ. σελ. 66, κ.λπ.|Ποιος;",
    "La Sra. Drawenti a las 10 p. m. del lunes.|¡Actualice!|«Aísle. Luego avise.», decía.|El n.º 9, etc.|¿Quién?",
]
JOINED = [
    "分析员写道：“先隔离主机。再通知我们。”然后离开了。|报告（见图12。）说明了。|日志；没有。|停用……|流量增加了25.87%。|是谁？",
    "「すぐに隔離する。その後。」と書いた。|誰が？|停止……|誰が",
]


@pytest.mark.parametrize("line", SPLIT)
def test_sentences(line):
    want = line.split("|")
    text = " ".join(want)
    assert [text[a:b] for a, b in sentences(text)] == want


@pytest.mark.parametrize("line", JOINED)
def test_sentences_without_blanks(line):
    text = line.replace("|", "")
    assert [text[a:b] for a, b in sentences(text)] == line.split("|")


@pytest.mark.parametrize("mark", [";", chr(0x37E)])
def test_greek_questions_inside_closing_marks(mark):
    line = '«Τι έγινε;»|Μετά ήρθε.|«Ποιος το είδε;» ρώτησε η Άννα.|(Ποιος άνοιξε;)|Η ομάδα.|"Ποιος άνοιξε;"|Το είπε.|Ρώτησε: «Ποιος; Πότε;»|Ποιος;'
    want = line.replace(";", mark).split("|")
    text = " ".join(want)
    assert [text[a:b] for a, b in sentences(text)] == want


@pytest.mark.parametrize(
    "line",
    [
        'The note said "' + "Isolate it. " * 300 + 'Call us." before the shift.|It ended.',
        "Logs were lost (" + "It fell. Why? " * 200 + "so they say).|It ended.",
        "See " + ", ".join(f"p. {i}" for i in range(1, 300)) + " of it.|It ended.",
    ],
)
def test_sentences_of_many_marks(line):
    want = line.split("|")
    text = " ".join(want)
    assert [text[a:b] for a, b in sentences(text)] == want


def test_units_and_offsets():
    text = "  1. Scope\n \nA b\nfell. Down\r\n\r\nlevel=warn msg=\"x. Y\"\n\n\n$ cmd?"
    assert [text[a:b] for a, b in sentences(text)] == ["1. Scope", "A b\nfell.", "Down", 'level=warn msg="x. Y"', "$ cmd?"]
    thai = "กข คง x จ"
    assert [thai[a:b] for a, b in sentences(thai)] == ["กข", "คง x จ"]
    assert [sentences(t) for t in (None, "", " \n\t")] == [[], [], []]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet='aB1 .!?…。"“”„«»()\n;:,ก。「」', max_size=60))
def test_sentences_cover_the_text_in_order(text):
    spans = sentences(text)
    assert all(a < b and not text[a].isspace() and not text[b - 1].isspace() for a, b in spans)
    assert all(p[1] <= q[0] for p, q in zip(spans, spans[1:]))
    assert "".join("".join(text[a:b] for a, b in spans).split()) == "".join(text.split())


@pytest.mark.parametrize("text", ["a. B " * 20_000, "(" * 50_000 + "]" * 50_000, "x; " * 30_000, "." * 100_000, '"' * 20_000, "word " * 50_000])
def test_long_texts(text):
    spans = sentences(text)
    assert spans[0][0] == 0 and spans[-1][1] == len(text.rstrip())


def test_split_frame(spark):
    rows = [(1, "Ab cd. Ef gh.", 1), (2, None, 1), (3, "", 1), (1, "Ab cd. Ef gh.", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, sent_start int")
    assert sorted(tuple(r) for r in split_sentences(df).collect()) == [(1, 0, 6), (1, 0, 6), (1, 7, 13), (1, 7, 13)]
    assert split_sentences(df.where("false")).count() == 0


def by_all_segmentations(text):
    """The best path by trying every set of candidates, with the documented span score."""
    cands = sentence_module._candidates(text)
    pairs = sentence_module._pairs(text)
    words = [m.start() for m in sentence_module._LENGTH_UNIT.finditer(text)]
    best = None
    for used in itertools.chain.from_iterable(itertools.combinations(range(len(cands)), k) for k in range(len(cands) + 1)):
        nodes = [(0, 0.0), *((cands[k].start, cands[k].open) for k in used)]
        ends = [*((cands[k].end, cands[k]) for k in used), (len(text), None)]
        total = 0.0
        for (start, opening), (end, c) in zip(nodes, ends):
            size = max(1, sum(start <= w < end for w in words))
            total += opening + sentence_module.LENGTH_SCORES.get(size, 0.0)
            if c:
                total += c.close + sentence_module.CUT_SCORE * sum(a < end <= b for a, b in pairs)
                total += sentence_module.SHORT_SCORE if size <= (2 if c.short else 1 if c.lead else 0) else 0.0
        if best is None or total > best[0] + 1e-9:
            best = (total, [(s, e) for (s, _), (e, _) in zip(nodes, ends)])
    return best


SPAN_TEXTS = [
    "We counted 1500. the U.S. Agents came.", "The U.S. Army left. It was late.", "See Fig. 3. No. 4 is new. Yes.", "Wait... what? He said (e.g. no. 3) it. Done!",
    "1. First. 2. Second point. 3. third", "Z. B. Herr Dr. K. Meier kam am 3. Mai. Danach ging er.", "A b. c d. E f.", "他说。「好。」我走。 Ok. fine.", "a.b.c. In. the. End. Of.",
]


@pytest.mark.parametrize("text", SPAN_TEXTS)
def test_best_path_equals_trying_all(text):
    got = sentence_module._unit(text)
    score, want = by_all_segmentations(text)
    assert got == want


def test_the_search_decides_where_a_left_to_right_pass_errs():
    """The weak end after 1500 would leave 'the U.S.' too short to end, so the later end is taken."""
    text = "We counted 1500. the U.S. Agents came."
    assert [text[a:b] for a, b in sentences(text)] == ["We counted 1500. the U.S.", "Agents came."]


def test_no_limit_on_words_and_marks():
    inner = " ".join(f"p. {i}." for i in range(150))
    assert len(sentences(f"He read ({inner}) and left. Then it rained.")) == 2
    assert len(sentences(f"{'x' * 300}. Next one.")) == 2
    assert len(sentences("α" * 40 + " " + "x" * 100 + " " + "β" * 80 + "; Ναι.")) == 2
