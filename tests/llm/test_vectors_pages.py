"""The vector and page operators against brute force, on odd and repeated rows."""

import base64
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from shipping import shipped  # noqa: F401
from tidegate.llm import ann, embdedup, hostrank, warc
from tidegate.llm.queries import ORACLE, QUERIES
from tidegate.llm.shared import scratch

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vectors(spark):
    draw = np.random.default_rng(1)
    base = draw.standard_normal((30, 16))
    rows = [(k, (base[k % 30] + 0.03 * draw.standard_normal(16)).tolist(), k % 3 and k % 30 % 2) for k in range(150)]
    rows += [(200 + k, base[0].tolist(), 0) for k in range(40)]
    rows += [(300, None, 0), (301, [], 0), (302, [0.0] * 16, 0), (303, [float("nan")] * 16, 0)]
    rows += [(304, [None] + [1.0] * 15, 0), (305, base[0].tolist(), None), (None, base[0].tolist(), 0)]
    rows += [(306, [float("inf")] + [1.0] * 15, 0), (307, [1.0, 2.0], 0), (308, [2.0, 4.0], 0), (200, base[0].tolist(), 0)]
    return spark.createDataFrame(
        [(i, v, None if lab is None else int(lab), 1) for i, v, lab in rows],
        "vec_id long, embedding array<double>, label int, node int",
    )


def sound(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_links_equal_brute_force(vectors, monkeypatch):
    monkeypatch.setattr(embdedup, "BLOCK", 16)
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    part = [r for r in rows if r[0] is not None and r[2] is not None and sound(r[1])]

    def close(a, b):
        x, y = np.array(a[1]), np.array(b[1])
        return a[2] == b[2] and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98

    links = {k: [m for m, o in enumerate(part) if m != k and close(r, o)] for k, r in enumerate(part)}
    root = [r[0] for r in part]
    for _ in part:
        root = [min([root[k], *(root[m] for m in links[k])]) for k in range(len(part))]
    want = sorted((r[0], len(links[k]), root[k], r[0] == root[k]) for k, r in enumerate(part))
    ids = {r[0] for r in part}
    want += [(r[0], 0, r[0], True) for r in rows if r[0] is not None and r[0] not in ids]
    got = embdedup.near_duplicates(vectors).collect()
    assert sorted(tuple(r) for r in got if r.vec_id is not None) == sorted(want)
    assert [tuple(r) for r in got if r.vec_id is None] == [(None, 0, None, False)]
    assert embdedup.near_duplicates(vectors.where("false")).count() == 0


def test_estimates_are_unbiased_and_bounded():
    draw = np.random.default_rng(3)
    a, b = draw.standard_normal((2, 4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = 0.7 * a + 0.4 * b / np.linalg.norm(b, axis=1, keepdims=True)
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    turn = embdedup.rotation(64, 5)
    assert np.allclose(turn @ turn.T, np.eye(64))
    code = np.sign(a @ turn.T) / 8
    factor = (code * (a @ turn.T)).sum(axis=1)
    error = (code * (b @ turn.T)).sum(axis=1) / factor - (a * b).sum(axis=1)
    assert abs(error.mean()) < 0.005
    assert (np.abs(error) <= 5 * np.sqrt((1 - factor**2) / factor**2 / 63)).all()


def test_search_finds_neighbours_in_order(vectors):
    got = ann.search(vectors, "vec_id % 10 = 0", sample=100, part_rows=20).collect()
    rows = [(r.vec_id, np.array(r.embedding)) for r in vectors.collect() if r.vec_id is not None and sound(r.embedding)]
    rows = [r for r in rows if len(r[1]) == 16]
    hit = total = 0
    for q in {i for i, _ in rows if i % 10 == 0}:
        own = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        v = next(v for i, v in rows if i == q)
        want = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for i, w in rows if i != q)[:10]
        assert [r[0] for r in own] == list(range(1, 11)) and q not in [r[1] for r in own]
        assert [(s, i) for _, i, s in own] == sorted((s, i) for _, i, s in own)
        hit += sum(s <= want[-1][0] + 1e-12 for _, _, s in own)
        total += 10
    assert hit / total >= 0.9
    assert ann.search(vectors.where("false"), "true").count() == 0
    assert ann.search(vectors.where("vec_id = 1"), "true").count() == 0


def test_small_tables_get_several_parts(spark, monkeypatch):
    routers, train = [], ann.train
    monkeypatch.setattr(ann, "train", lambda *a, **b: routers.append(train(*a, **b)) or routers[-1])
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert ann.search(table, "vec_id % 100 = 0").count() == 50
    assert routers[0].second.shape[1] == 8


def test_balanced_parts_are_balanced():
    x = np.random.default_rng(0).standard_normal((400, 8))
    part = ann.balanced_parts(ann.neighbours(x, 5), 8)
    assert np.bincount(part, minlength=8).max() <= np.ceil(1.1 * 400 / 8)


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "é\U0001f600" * 60 + "</p>"
    rows = [(9, "http://A.b/x y\r\nz", big), (4, "u", big), (7, None, big), (1, "s", "short"), (2, "s", "short")]
    rows += [(5, "n", None), (6, "e", ""), (8, "l", "long " * 200_000), (None, "i", big), (10, "h", "a\r\n\r\nb" * 50)]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, first string")


def test_archives_round_trip(spark, pages):
    folder = scratch(spark, "warc-test")
    index = warc.write_archives(warc.revisits(pages), folder)
    got = {r.page_id: r for r in warc.read_records(spark, index, folder).collect()}
    for r in pages.collect():
        body, own = (r.html or "").encode(), got[r.page_id]
        assert (own.payload_bytes, own.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
        again = r.page_id in (9, 7, None)
        assert (own.record_type, own.refers_to) == (("revisit", 4) if again else ("response", None))
        assert own.payload == (None if again else body)
    some = warc.read_records(spark, index.where("page_id IN (1, 8)"), folder).collect()
    assert sorted(r.page_id for r in some) == [1, 8]
    assert warc.round_trip(pages.where("false")).count() == 0


def test_records_hold_what_the_format_demands(spark, tmp_path):
    body = "ünïcode " * 30
    pages = spark.createDataFrame([(3, "http://a/x", body), (5, "http://b/y z", body), (7, None, None)], "page_id long, url string, html string")
    folder = scratch(spark, "warc-format")
    index = warc.write_archives(warc.revisits(pages), folder).collect()
    found = {}
    for r in index:
        with open(f"{folder.removeprefix('file:')}/{r.file}", "rb") as f:
            f.seek(r.offset)
            data = zlib.decompress(f.read(r.length), 31)
        head, _, rest = data.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines)
        assert version == "WARC/1.1" and len(rest) == int(fields["Content-Length"]) + 4
        assert {"WARC-Record-ID", "WARC-Date", "WARC-Type", "Content-Type", "Content-Length"} <= set(fields)
        assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["WARC-Date"])
        assert rest.startswith(b"HTTP/1.1 200 OK\r\n")
        found[r.page_id] = fields, rest[:-4].partition(b"\r\n\r\n")[2]
    first, again = found[3][0], found[5][0]
    digest = base64.b32encode(hashlib.sha256(body.encode()).digest()).decode()
    assert first["WARC-Payload-Digest"] == again["WARC-Payload-Digest"] == f"sha256:{digest}"
    assert (found[3][1], found[5][1], found[7][1]) == (body.encode(), b"", b"")
    assert again["WARC-Refers-To"] == first["WARC-Record-ID"] != again["WARC-Record-ID"]
    assert again["WARC-Type"] == "revisit" and again["WARC-Profile"] == warc.PROFILE


def test_ranges_join_neighbours_only():
    far = warc.GAP + 1000
    assert warc.ranges([0, 10, far], [10, 5, 7]) == [(0, 15, [(0, 10), (10, 5)]), (far, far + 7, [(far, 7)])]


def test_rules_and_hosts(spark):
    urls = {
        1: ("HTTP://WWW.Example.NET/en/a?b#c", "www.example.net", "/en/a", "example.net/en/", "allow"),
        2: ("x://example.net", "example.net", "", None, "allow"),
        3: ("x://a.net/q", "a.net", "/q", "net/", "block"),
        4: ("http://example.com/de/x", "example.com", "/de/x", "example.com/de/", "block"),
        5: ("http://badexample.com/de/x", "badexample.com", "/de/x", None, "allow"),
        6: ("http://a.org/fr/?u=http://b.net/", "a.org", "/fr/", "org/fr/", "allow"),
        7: (None, "", "", None, "allow"),
        8: ("no scheme/net/", "", "", None, "allow"),
        9: ("http://ÄB.org?x", "Äb.org", "", None, "allow"),
    }
    frame = spark.createDataFrame([(k, u[0], None, "x") for k, u in urls.items()], "page_id long, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in hostrank.judge(frame).collect()}
    assert got == {k: u[1:] for k, u in urls.items()}
    assert hostrank.judge(frame.where("false")).count() == 0


def test_distrust_flows_against_links_and_trust_along(spark):
    def page(k, url, *to):
        return (k, url, "".join(f'<a HREF="{t}">' for t in to))

    rows = [
        page(1, "http://farm.io/", "http://s1.net/x", "//s2.net/y", "/own"),
        page(2, "http://s1.net/x"),
        page(3, "http://s2.net/y"),
        page(4, "http://good.org/fr/", "http://friend.io/"),
        page(5, "http://friend.io/", "http://s1.net/x"),
        page(6, "http://plain.io/"),
    ]
    rows += [page(10 + k, f"http://h{k}.io/") for k in range(30)]
    out = {r.page_id: r for r in hostrank.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[1].verdict == "block" and out[1].rule is None
    assert out[5].verdict == "allow" and out[5].trust > 0 and out[6].verdict == "allow"

    links = [("farm.io", "s1.net"), ("farm.io", "s2.net"), ("good.org", "friend.io"), ("friend.io", "s1.net")]
    hosts = sorted({h for pair in links for h in pair})
    trust, bad = {h: float(h == "good.org") for h in hosts}, {h: 0.5 * h.endswith(".net") for h in hosts}
    t, d = dict(trust), dict(bad)
    for _ in range(10):
        nt, nd = {h: 0.15 * trust[h] for h in hosts}, {h: 0.15 * bad[h] for h in hosts}
        for a, b in links:
            nt[b] += 0.85 * t[a] / sum(x == a for x, _ in links)
            nd[a] += 0.85 * d[b] / sum(y == b for _, y in links)
        t, d = nt, nd
    got = {r.host: (r.trust, r.distrust) for r in out.values()}
    assert all(np.allclose(got[h], (t[h], d[h])) for h in hosts)


def test_hosts_without_a_page_are_seeds(spark):
    links = {
        "farm.io": "//S1.net/x?q http://s2.net",
        "fan.io": "https://example.com/de/x",
        "other.io": "https://example.com/en/x",
        "kind.io": "http://good.org/fr/",
        "bare.io": "http://s3.net?q#f",
    }
    rows = [(k, f"http://{h}/", "".join(f"<a href='{u}'>" for u in to.split())) for k, (h, to) in enumerate(links.items())]
    rows += [(100 + k, f"http://h{k}.io/", None) for k in range(60)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.host: (r.rule, r.verdict, r.trust, r.distrust) for r in hostrank.judge(frame).collect()}
    # example.com has a blocked url among the linked ones, so who links to it receives its distrust.
    assert {h for h, r in out.items() if r[1] == "block"} == {"farm.io", "fan.io", "other.io", "bare.io"}
    seed = 0.15 / 4
    want = {"farm.io": 2 * 0.85 * seed, "fan.io": 0.85 * seed / 2, "other.io": 0.85 * seed / 2, "bare.io": 0.85 * seed}
    assert all(np.isclose(out[h][3], d) and out[h][0] is None for h, d in want.items())
    got = {(r.src, r.dst): (r.good, r.bad) for r in hostrank.host_links(frame).collect()}
    assert got["kind.io", "good.org"] == (1, 0) and got["fan.io", "example.com"] == (0, 1)
    assert got["other.io", "example.com"] == (0, 0) and got["bare.io", "s3.net"] == (0, 1)


def test_distrust_reaches_hosts_far_from_every_seed(spark):
    far = 14
    chain = [f"c{k}.io" for k in range(far)] + ["end.net"]
    rows = [(k, f"http://{a}/", f'<a href="//{b}/">') for k, (a, b) in enumerate(zip(chain, chain[1:], strict=False))]
    rows += [(100 + k, f"http://h{k}.io/", None) for k in range(100)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.host: (r.verdict, r.distrust) for r in hostrank.judge(frame).collect()}
    assert all(out[h][0] == "block" and np.isclose(out[h][1], 0.15 * 0.85 ** (far - k)) for k, h in enumerate(chain[:-1]))
    hosts = spark.createDataFrame([(h, 0.0, float(h == "end.net")) for h in chain], "host string, good double, bad double")
    with pytest.raises(RuntimeError):
        hostrank.spread(hosts, hostrank.host_links(frame), rounds=far - 1)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("pages", "embeddings", "documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_pipeline_runs_and_keeps_its_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes
    out = corpus_pipeline.run(spark, SF)
    assert out.where("length > 2048 OR offset < 0").count() == 0 and out.count() > 0


def test_a_query_gets_all_its_neighbours_though_its_parts_are_small(spark):
    draw = np.random.default_rng(2)
    centres = draw.standard_normal((60, 8)) * 50
    rows = [(i, (centres[i % 60] + draw.standard_normal(8) * 0.01).tolist()) for i in range(300)]
    frame = spark.createDataFrame([*rows, (0, rows[0][1])], "vec_id long, embedding array<double>")
    got = ann.search(frame, "vec_id % 100 = 0", k=60, part_rows=16).groupBy("query_id").count().collect()
    assert {r["query_id"]: r["count"] for r in got} == {0: 60, 100: 60, 200: 60}
    assert ann.search(frame, "vec_id = 0", k=500, part_rows=16).count() == 299
