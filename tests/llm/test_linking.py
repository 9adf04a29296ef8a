"""Hard negatives, ranked search and linked credentials against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tamiz.llm import credentials, lexical, negatives

SF = "/root/testdata/sf0.001"


def bag(rows):
    return Counter(map(repr, map(tuple, rows)))


def mined(rows):
    """Rows are (vec_id, vector, label); every pair is scored in Python integers."""
    good = [(i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, (a, q, own) in enumerate(good):
        if a % 100:
            continue
        pairs = sorted(((sum(x * y for x, y in zip(q, p)), i, label == own) for j, (i, p, label) in enumerate(good) if j != k), key=lambda r: (-r[0], r[1]))
        for p, i, _ in [r for r in pairs if r[2]][:5]:
            window = [r for r in pairs if not r[2] and 30 * p <= 100 * r[0] <= 90 * p][:10]
            out += [(a, i, n + 1, j, p, s) for n, (s, j, _) in enumerate(window)]
    return out


VECTORS = "vec_id long, embedding array<double>, label int, row long, score long, q long, positives string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, 3, "x") for i, v, label in rows], VECTORS)


def some_vectors(n=260, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0.2, 0.5) for _ in range(6)], rng.randrange(4)) for i in range(-100, n)]
    same = [0.5, -0.25, 0.125, 0.0, 0.5, 0.25]
    rows += [(n + i, same, i % 3) for i in range(60)]  # ties
    rows += [(200, same, 1), (200, same, 1), (3, same, 2)]  # repeated ids
    rows += [(300, [0.0] * 6, 1), (400, [-x for x in same], 2), (500, [0.0] * 6, 2), (501, [0.0] * 6, 1), (502, [0.0] * 6, 2)]  # positives of score 0 and below
    rows += [(None, same, 1), (600, None, 1), (700, same, None), (800, [None, 1.0], 1), (900, [float("nan")] * 6, 1), (1000, [float("inf")] * 6, 1)]
    rows += [(1100, [], 1), (1101, [0.5, 0.5], 1), (1200, [0.5, -0.5, 0.25], 2), (1201, [1.0] * 9, 3)]  # of other lengths
    return rows


@pytest.mark.parametrize("size", [None, (3, 17)])
def test_hard_negatives(spark, monkeypatch, size):
    if size:
        monkeypatch.setattr(negatives, "ANCHORS", size[0])
        monkeypatch.setattr(negatives, "ROWS", size[1])
    rows = some_vectors()
    want = mined(rows)
    assert len(want) > 500 and any(p == 0 for *_, p, _ in want)
    assert bag(negatives.hard_negatives(vectors(spark, rows)).collect()) == bag(want)


def test_hard_negatives_of_nothing(spark):
    assert negatives.hard_negatives(vectors(spark, [(100, [1.0], 1)]).where("vec_id < 0")).count() == 0
    assert negatives.hard_negatives(vectors(spark, [(1, [1.0], 1), (2, [1.0], 2)])).count() == 0


def test_products_beyond_doubles():
    rng = np.random.default_rng(0)
    x, y = rng.integers(-500, 500, (5, 8)), rng.integers(-500, 500, (7, 8))
    x[1, 2], y[3, 2], y[4, 2] = 2**31 + 1, 2**27 + 3, 2**62
    got = negatives._exact(x, y)
    for i, j in np.ndindex(5, 7):
        exact = sum(int(a) * int(b) for a, b in zip(x[i], y[j]))
        assert got[i, j] == max(-negatives.LIMIT, min(negatives.LIMIT, exact))


def test_keys_sort_as_pairs_do():
    rng = random.Random(1)
    pairs = [(rng.randrange(3), rng.choice([-(2**56), -1, 0, 1, 7, 2**56]), rng.random() < 0.5, rng.choice([-(2**63), -5, 0, 5, 2**63 - 1])) for _ in range(300)]
    assert sorted(pairs, key=lambda p: negatives.packed(*p)) == sorted(pairs, key=lambda p: (p[0], -p[1], p[2], p[3]))


def test_a_stream_opens_windows_and_keeps_none_of_the_pairs():
    # An anchor without positives emits nothing; a sixth positive opens no window; each window closes after ten.
    stream = [(negatives.packed(1, 500 - i, True, i), 10) for i in range(50)]
    stream += sorted((negatives.packed(2, 100 - i, False, i), 20) for i in range(6)) + [(negatives.packed(2, 80, True, 100 + i), 20) for i in range(12)]
    got = list(negatives.mined(iter(stream)))
    assert Counter(r[1] for r in got) == {i: 10 for i in range(5)} and {r[0] for r in got} == {20}
    assert [r[3] for r in got if r[1] == 3] == list(range(100, 110))


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def searched(docs, items, top=20):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    held = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        asked, found = Counter(TERM.findall(lower(text))), []
        for i, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n) // total
            s = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t, k in asked.items() if t in c)
            if s > 0:
                found.append((-s, i is None, i, s))
        out += [(item, r + 1, i, s) for r, (_, _, i, s) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return out


@pytest.mark.parametrize("sizes", [None, (40, 3)])
def test_ranked(spark, given, empty, monkeypatch, sizes):
    if sizes:
        monkeypatch.setattr(lexical, "BUCKET", sizes[0] * 50)
        monkeypatch.setattr(lexical, "ITEMS", sizes[1])
    docs = [(r.doc_id, r.text) for r in given.select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:12]
    items += [(None, items[0][1]), (1, items[1][1]), (50, None), (51, ""), (52, "nowhere-to-be-found"), (53, "THE the The a"), (54, "CONTACT card é漢字 😀"), (55, docs[6][1])]
    table = spark.createDataFrame([(i, t, 1.0, 1) for i, t in items], "item_id long, text string, score double, row long")
    assert bag(lexical.ranked(given, table).collect()) == bag(searched(docs, items))
    assert lexical.ranked(empty, table).count() == 0 == lexical.ranked(given, table.where("item_id > 99")).count()


def test_buckets_are_pruned_and_bounds_hold(spark, monkeypatch):
    """Random sparse vectors: within a bucket exactly the best that reach the threshold come out, and few are scored for them."""
    rng = np.random.default_rng(4)
    vectors = [(i, np.sort(rng.choice(60, rng.integers(1, 25), replace=False))) for i in range(400)]
    bucket = pa.table({
        "row": [i for i, _ in vectors], "id": [None if i == 7 else i for i, _ in vectors],
        "coordinates": [c.tolist() for _, c in vectors], "values": [rng.integers(1, 10**6, len(c)).tolist() for _, c in vectors],
    })
    terms = [np.sort(rng.choice(80, 9, replace=False)).tolist() for _ in range(30)]
    weights = [rng.integers(1, 9000, 9).tolist() for _ in range(30)]
    exact = [[sum(w * v for t, w in zip(ts, ws) for c, v in zip(cs, vs) if c == t) for cs, vs in zip(bucket["coordinates"].to_pylist(), bucket["values"].to_pylist())] for ts, ws in zip(terms, weights)]
    for quantile in (0.0, 0.9, 0.99, 1.0):
        least = [max(1, int(np.quantile(e, quantile))) for e in exact]
        least[0] = 10**15  # no vector is long enough
        got = lexical._search(pa.table({"row": range(30), "coordinates": terms, "values": weights, "least": least}), bucket).to_pylist()
        for k in range(30):
            want = sorted(((-s, i == 7, i) for i, s in enumerate(exact[k]) if s >= least[k]))[: lexical.TOP]
            assert [(r["score"], r["id"]) for r in got if r["row"] == k] == [(-s, None if i == 7 else i) for s, _, i in want]


def test_query_11_and_12_against_sql(spark):
    for module in (negatives, lexical):
        (name, query), sql = *module.QUERIES.items(), list(module.ORACLES.values())[0]
        con = duckdb.connect()
        for t in ("documents", "embeddings", "benchmark"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        want = con.sql(sql)
        got = query(spark, SF).select(*want.columns)
        assert bag(got.collect()) == bag(want.fetchall()), name


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def printed(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


KEY = "AKIA" + "ABCDEFGHIJKLMNOP"
HEX = "0123456789abcdef" * 2
MIXED = "q7Wz9Lk2Xv5Bn8Md"
SHORT = "3e5cb3f9186ce4f74964"
FAR = " word" * 60
SECRETS = [
    f"password={KEY} Token : 'abc.def=' secret:token:abcdef passwd=\"short api_key=12345 APIKEY==abcdef tokentoken=abcdef",
    f"{KEY[:19]} {KEY} X{KEY}AKIA {HEX[:23]} {HEX}g{HEX}, é漢 {HEX} Password\x20\x20=\x20\x20secretsecret ſecret=abcdef toKen=abcdef",
    # Weak candidates with and without their complements.
    f"login: alice_b key {MIXED} done", f"login: alice_b{FAR} key {MIXED} done", f"login: alice_b\n\nkey {MIXED} done", "login: alice_b alone", f"only {MIXED} alone",
    f"see https://db.example.com/x?y=1, with {MIXED}.", "see https://db.example.com/x and 10.0.0.1:8080 alone", f"host=db1.internal user=bob pwd=hunter2hunter at 10.0.0.1:8080 or db.x.org:5432 {KEY}",
    f"bob@mail.example.com token = \"{HEX}\" eve@mail.example.com" + FAR + "zed@mail.example.com", f"client_id: 77abc\n \t\nclient_id: 78abc\nsecret={HEX}", "x" * 3000 + f" user=bob {MIXED}" + "y9" * 3000 + " user=eve1",
    f"aws_access_key_id = ASIAABCDEFGHIJKLMNOP\naws_secret = x\nprivate_key={MIXED}/+{MIXED}==", f"user=bob {SHORT} {SHORT}", "justaverylongwordwithoutdigits user=bob anotherverylongword_without_digits", f"\n\n\n{MIXED}\n\n\n", "",
]


def test_secrets(spark, given, empty):
    more = spark.createDataFrame([(5000 + i, t) for i, t in enumerate(SECRETS)], "doc_id long, text string")
    docs = given.select("doc_id", "text").unionByName(more)
    text = defaultdict(list)
    for r in docs.collect():
        text[r.doc_id].append(r.text or "")
    rows = credentials.secrets(docs.withColumns({"row": F.lit(1), "kinds": F.lit(2), "spans": F.lit(3)})).collect()
    assert Counter(r.doc_id for r in rows) == Counter({i: len(t) for i, t in text.items()})
    for r in rows:
        want = {printed(base_spans(t)) for t in text[r.doc_id]}
        own = printed([x for x in parsed(r.spans) if x[3] in credentials.BASE])
        assert own in want and hashlib.sha256(own.encode()).hexdigest() == r.base_sha256
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(own.count(f"{k}:") for k in credentials.BASE)
        assert r.n_linked == len(parsed(r.spans)) - len(parsed(own))
    assert sum(r.n_assign for r in rows) >= 8 and credentials.secrets(empty).count() == 0


def parsed(spans):
    cut = [s.split(":") for s in spans.split(",") if s]
    return [(int(a), credentials.KINDS.index(k), int(b), k) for k, a, b in cut]


def added(spark, texts):
    """For each text the weak candidates that were reported, as (kind, text)."""
    rows = credentials.secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [[(k, texts[r.doc_id][a:b]) for a, _, b, k in parsed(r.spans) if k in credentials.WEAK] for r in sorted(rows)]


def test_weak_candidates_need_their_complements(spark):
    got = added(spark, SECRETS)
    assert got[2] == [("id", "login: alice_b"), ("secret", MIXED)]
    assert got[3] == got[4] == got[5] == got[6] == got[8] == got[15] == got[16] == []
    assert got[7] == [("secret", MIXED)]  # an endpoint is reported with identifier and secret only
    assert got[9] == [("endpoint", "host=db1.internal"), ("id", "user=bob"), ("secret", "pwd=hunter2hunter"), ("endpoint", "10.0.0.1:8080"), ("endpoint", "db.x.org:5432")]
    assert got[10] == [("id", "bob@mail.example.com"), ("id", "eve@mail.example.com")]
    assert got[11] == [("id", "client_id: 78abc")]
    assert got[12] == [("id", "user=bob"), ("secret", MIXED + "y9" * 3000), ("id", "user=eve1")]
    assert got[13] == [("id", "aws_access_key_id = ASIAABCDEFGHIJKLMNOP"), ("secret", f"private_key={MIXED}/+{MIXED}==")]
    assert got[14] == [("id", "user=bob"), ("secret", SHORT), ("secret", SHORT)]


def test_scopes_against_plain_python(spark):
    """Random texts of parts at random distances, with the parts taken as found and the scopes held pair by pair."""
    rng = random.Random(2)
    piece = [f"user=bob{{}}x", f"{MIXED}{{}}A1", "10.0.0.{}", f"token={HEX}{{}}", KEY + "{}", "\n\n", "\n", " lorem" * 8, " lorem" * 30]
    texts = [" ".join(rng.choice(piece).format(rng.randrange(10, 99)) for _ in range(rng.randrange(1, 40))) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = credentials._found(docs)
    parts = credentials._parts(found).join(found.select("row", "doc_id"), "row").collect()
    by_doc = defaultdict(list)
    for p in parts:
        by_doc[p.doc_id].append(p)
    want, roles = Counter(), credentials.ROLES
    for i, own in by_doc.items():
        cuts = [m.span() for m in re.finditer(r"\n[\x20\t\r]*\n", texts[i])]
        for p in own:
            low, high = max([0, *[e for _, e in cuts if e <= p.start]]), min([10**9, *[s for s, _ in cuts if s >= p.end]])
            assert p.low == low and min(p.high, 10**9) == high
            near = {roles[q.kind] for q in own if q.start < min(p.end + 200, high) and q.end > max(p.start - 200, low)}
            if {"id": "secret" in near, "secret": bool({"id", "endpoint"} & near), "endpoint": {"id", "secret"} <= near}.get(p.kind):
                want[i, p.kind, p.start, p.end] += 1
    got = Counter((x, k, a, b) for x, r in zip(range(len(texts)), sorted(credentials.secrets(docs).collect())) for a, _, b, k in parsed(r.spans) if k in credentials.WEAK)
    assert got == want and len(want) > 200


def test_the_method_adds_secrets(spark):
    rows = credentials.secrets(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    assert rows.agg(F.sum("n_linked")).first()[0] > 0
