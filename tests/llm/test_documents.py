"""The document operators against their definitions, on odd and repeated rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from shipping import shipped  # noqa: F401
from pyspark.sql import functions as F
from tidegate.llm import binpack, bpe, linededup, packing, quality, shared, simhash, tokens
from tidegate.llm.shared import components
from tokenizers import Tokenizer

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
WORDS = "alpha Beta gamma, delta 42 don't été \u00a0x ßtrange end. 日本 a\tb".split(" ")


def texts(n, seed):
    draw = random.Random(seed)
    return [" ".join(draw.choices(WORDS, k=draw.randint(1, 60))) for _ in range(n)]


ODD = [None, "", " ", "  two  spaces ", "\n\nlines\n", "<|endoftext|> a<|endoftext|>b", "x" * 3000, "the end " * 4000]


@pytest.fixture(scope="module")
def docs(spark):
    body = ODD + texts(40, 1)
    rows = [(k, t, "x", "y") for k, t in enumerate(body)]
    rows += [(100, body[10], "x", None), (100, body[10], "x", None), (None, body[11], None, "z"), (101, None, None, None)]
    # columns that clash with names used inside the operators
    return spark.createDataFrame(rows, "doc_id long, text string, fp string, component string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def fingerprint(text):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    own = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in own]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups_equal_brute_force(docs):
    got = simhash.near_duplicates(docs).collect()
    rows = [(r.doc_id, fingerprint(r.text)) for r in docs.collect()]
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(d), f"{f:016x}") for d, f in rows)
    groups = {f: {f} for _, f in rows}
    for _ in range(len(groups)):
        for a in groups:
            groups[a] = set().union(*(groups[b] for b in groups if any((b ^ c).bit_count() <= 4 for c in groups[a])))
    for r in got:
        group = groups[int(r.fingerprint, 16)]
        ids = [d for d, f in rows if f in group and d is not None]
        assert r.component_id == min(ids, default=None)


@pytest.mark.parametrize("max_bits,count", [(4, 3), (4, 2), (3, 4), (6, 3), (1, 3), (0, 3)])
def test_every_pair_within_the_distance_is_probed(spark, max_bits, count):
    draw = random.Random(max_bits * 10 + count)
    prints = {draw.getrandbits(64) for _ in range(6)}
    for p in list(prints):
        for _ in range(12):
            prints.add(p ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, max_bits + 2))))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {(r.a, r.b) for r in simhash.links(frame, max_bits, count).collect()}
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits
    assert got == {(a, b) for a in signed for b in signed if a < b and near(a, b)}


@pytest.mark.parametrize("count", [2, 3, 5])
def test_groups_are_the_components_of_all_links(spark, count):
    draw = random.Random(count)
    seeds = [draw.getrandbits(64) for _ in range(25)]
    prints = set(seeds)
    for s in seeds:
        for _ in range(draw.randint(0, 25)):  # chains and clouds around each seed
            s = draw.choice([s, s, seeds[0]]) ^ sum(1 << draw.randrange(64) for _ in range(draw.randint(1, 6)))
            prints.add(s & (2**64 - 1))
    signed = [(p - 2**64 if p >> 63 else p,) for p in prints]
    frame = spark.createDataFrame(signed, "fp long").persist()
    want = {r.node: r.component for r in components(simhash.links(frame, 4, 3)).collect()}
    assert {r.node: r.component for r in simhash.groups(frame, 4, count).collect()} == want


def test_a_cluster_needs_as_many_links_as_members(spark, monkeypatch):
    made = []
    monkeypatch.setattr(simhash, "components", lambda links: made.append(links.count()) or components(links))
    base = 0x0123456789ABCDEF
    prints = {base ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(64)}
    frame = spark.createDataFrame([(p - 2**64 if p >> 63 else p,) for p in prints], "fp long").persist()
    found = simhash.groups(frame).collect()
    assert len(found) == len(prints) > 2000 and len({r.component for r in found}) == 1
    assert max(made) <= 4 * len(prints)


def test_what_probes_make_of_few_rows_is_not_broadcast(spark, monkeypatch):
    plans = []

    def seen(df, label):
        out = simhash_staged(df, label)
        plans.append((label, df._jdf.queryExecution().toString()))
        return out

    simhash_staged = simhash.staged
    draw = random.Random(8)
    frame = spark.createDataFrame([(draw.getrandbits(63),) for _ in range(3000)], "fp long")
    frame = simhash_staged(frame, "few")
    monkeypatch.setattr(simhash, "staged", seen)
    monkeypatch.setattr(simhash, "components", lambda links: plans.append(("links", links._jdf.queryExecution().toString())) or components(links))
    pairs = simhash.links(frame)
    assert pairs.count() == 0 and simhash.groups(frame).count() == 0
    plans.append(("pairs", pairs._jdf.queryExecution().toString()))
    # 135,000 probes; stars join 9,000 rows and may be broadcast
    for label, plan in plans:
        if label in ("pairs", "links") and "explode" in plan:
            assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_stars_of_many_edges_are_not_broadcast(spark, monkeypatch):
    edges = spark.range(1, 60).select(F.col("id").alias("hi"), F.lit(0).cast("long").alias("lo"))
    plan = lambda df: df._jdf.queryExecution().toString()
    for step in (shared._large_star, shared._small_star):
        assert "BroadcastHashJoin" not in plan(step(edges, shared.BROADCAST_ROWS + 1))
        assert "BroadcastHashJoin" in plan(step(edges, 59))


def test_first_of_groups_keeps_columns_and_null_ids(docs, empty):
    left = simhash.first_of_groups(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert None in ids and 100 not in ids and 101 not in ids
    assert simhash.near_duplicates(empty).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(1, k) for k in range(2, 60)] + [(7, 7), (None, 3)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{k: 100 for k in range(100, 161)}, **{k: 1 for k in range(1, 60)}}


def test_packing_holds_every_id_once(docs, empty):
    rows = packing.pack(docs, JSON, PATTERN, max_len=64, with_ids=True).collect()
    slow = Tokenizer.from_file(JSON)
    want = sorted(
        np.array([*slow.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        for r in docs.collect()
    )
    by_sequence, by_doc = {}, {}
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        if r.doc_id not in (None, 100):
            by_doc.setdefault(r.doc_id, []).append((r.start, bytes(r.ids), r.doc_tokens))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for own in by_doc.values():
        whole = b"".join(ids for _, ids, _ in sorted(own))
        assert whole in want and len(whole) == 4 * own[0][2]
    assert sum(r.length for r in rows) == sum(len(w) // 4 for w in want)
    assert packing.pack(empty, JSON, PATTERN).count() == 0


@pytest.mark.parametrize("text", ["", "ten small words are what this one row holds now"])
def test_short_documents_leave_little_padding(spark, text):
    frame = spark.createDataFrame([(k, text) for k in range(20_000)], "doc_id long, text string").repartition(4)
    rows = packing.pack(frame, JSON, PATTERN).collect()
    used = sum(r.length for r in rows)
    sequences = len({r.sequence_id for r in rows})
    places = sorted((r.sequence_id, r.offset, r.offset + r.length) for r in rows)
    assert len(rows) == 20_000 and sum(b[1] != (a[2] if a[0] == b[0] else 0) for a, b in zip(places, places[1:])) == 0
    assert max(stop for _, _, stop in places) <= 2048 and sequences <= 1.02 * -(-used // 2048)


LONG = [" " * 300_000 + "x", "\n" * 300_000 + "x", "a" * 300_000, "." * 300_000, "x " * 150_000]


def test_very_long_texts_are_encoded_whole(spark):
    slow = Tokenizer.from_file(JSON)
    frame = spark.createDataFrame(list(enumerate(LONG)), "doc_id long, text string")
    want = {k: np.array([*slow.encode(t, add_special_tokens=False).ids, 1], "<u4") for k, t in enumerate(LONG)}
    found = {k: [] for k in want}
    for r in packing.pack(frame, JSON, PATTERN, with_ids=True).collect():
        found[r.doc_id].append((r.start, bytes(r.ids)))
    assert {k: b"".join(ids for _, ids in sorted(v)) for k, v in found.items()} == {k: w.tobytes() for k, w in want.items()}
    rows = binpack.matrices(frame, JSON, PATTERN).collect()
    assert sum(r.n_tokens for r in rows) == sum(map(len, want.values()))
    for r in bpe.encoded(frame, RANKS, PATTERN, with_ids=True).collect():
        assert bytes(r.ids) == want[r.doc_id][:-1].tobytes()


@pytest.mark.parametrize("seed", range(6))
def test_patterns_meet_the_demand_as_well_as_best_fit(seed):
    draw = np.random.default_rng(seed)
    need = np.zeros(packing.CLASSES + 1, np.int64)
    sizes = draw.choice(np.arange(1, 257), size=draw.integers(1, 257), replace=False)
    need[sizes] = draw.integers(1, 200, len(sizes))
    found = packing.cutting_patterns(need)
    assert (sum(c * t for c, t in found) == need).all()
    assert all((c * np.arange(257)).sum() <= 256 for c, _ in found)
    lengths = np.repeat(np.arange(257), need).tolist()
    assert sum(t for _, t in found) <= 1.002 * len(binpack.best_fit_decreasing(lengths, 256)) + 3
    assert packing.cutting_patterns(np.zeros(257, np.int64)) == []


def test_fast_ids_equal_the_tokenizer_file():
    own, slow = tokens.Encoder(JSON, PATTERN), Tokenizer.from_file(JSON)
    assert own.fast is not None
    for t in [t or "" for t in ODD] + texts(200, 5):
        assert np.frombuffer(own.encode(t), "<u4").tolist() == slow.encode(t, add_special_tokens=False).ids


def test_matrices_are_lossless(docs, empty):
    rows = binpack.matrices(docs, JSON, PATTERN, max_len=64, batch_tokens=1500).collect()
    found = {}
    for r in rows:
        line = np.frombuffer(r.ids, "<u2")
        assert len(line) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 64
        assert r.position_resets == r.cu_seqlens[:-1] and not line[r.n_tokens :].any()
        for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            found.setdefault(d, []).append((s, line[a:b].tolist()))
    slow = Tokenizer.from_file(JSON)
    for r in docs.where("doc_id < 100").collect():
        ids = [i for _, part in sorted(found[r.doc_id]) for i in part]
        assert ids == [*slow.encode(r.text or "", add_special_tokens=False).ids, 1]
    assert len({r.sequence for r in rows}) == len(rows)
    assert binpack.matrices(empty, JSON, PATTERN).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_takes_the_fullest_sequence(seed):
    draw = random.Random(seed)
    lengths = [draw.randint(1, 50) for _ in range(300)]
    free, want = [], []
    for i in sorted(range(300), key=lambda i: (-lengths[i], i)):
        fit = min((f for f in free if f >= lengths[i]), default=None)
        if fit is not None:
            free.remove(fit)
        free.append((50 if fit is None else fit) - lengths[i])
        want.append(fit is None)
    got = binpack.best_fit_decreasing(lengths, 50)
    assert len(got) == sum(want) and sorted(i for own in got for i in own) == list(range(300))
    assert all(sum(lengths[i] for i in own) <= 50 for own in got)


def test_bpe_equals_the_library_and_round_trips(docs, empty):
    own = bpe.Codec(RANKS, PATTERN)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    for r in bpe.encoded(docs, RANKS, PATTERN).collect():
        t = next(d.text for d in docs.collect() if d.doc_id == r.doc_id) or ""
        ids = np.array(library.encode_ordinary(t), "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert bpe.encoded(empty, RANKS, PATTERN).count() == 0


def test_prefix_tables_append_and_edit_exactly():
    own, draw = bpe.Codec(RANKS, PATTERN), random.Random(2)
    data, last = b"", []
    for _ in range(30):
        data, last = own.append(data, last, bytes(draw.choices(b"abcethionrs ing", k=draw.randint(1, 6))))
        assert own.walk(last) == own.merges(data)
    for _ in range(30):
        i = draw.randrange(len(data))
        data, last = own.edit(data, last, i, min(len(data), i + draw.randint(0, 3)), b"the"[: draw.randint(0, 3)])
        assert own.walk(last) == own.merges(data)


def long(seed, n=30):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(n))


def test_later_passages_go_and_clean_documents_stay(spark):
    a, b, c = long(1), long(2), long(3)
    two = [long(4, 15), long(5, 15)]
    rows = [
        (5, f"{a}\nown five\n{b}", "k"),
        (9, f"head\n{a}\nmiddle\nshort", "k"),
        (3, f"{c}\nshort", "k"),
        (7, f"{b}\nshort\n{c}", "k"),
        (11, "\n".join(["x", *two, "y"]), "k"),
        (12, "\n".join(["p", *two, "q"]), "k"),
        (13, f"{two[0]}\nbetween\n{two[1]}", "k"),
        (14, None, "k"),
        (15, "", "k"),
        (16, f"{long(9)}\nclean\n\n", "k"),
        (17, f"{long(10)}\n", None),
        (17, f"{long(10)}\n", None),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, gone__x string")
    got = linededup.dedup_lines(frame)
    assert got.columns == [*frame.columns, "lines_removed"]
    out = {r.doc_id: (r.text, r.lines_removed) for r in got.collect()}
    assert out[3][0] == rows[2][1] and out[5][0] == rows[0][1]
    assert out[9] == ("head\nmiddle\nshort", [1])
    assert out[7] == ("short", [0, 2])
    assert out[12] == ("p\nq", [1, 2])
    assert out[13][0] == rows[6][1]  # its lines are apart, so neither block is long enough
    assert out[14][0] is None and out[15][0] == "" and out[16][0] == rows[9][1] and out[17][0] == rows[10][1]
    assert got.count() == len(rows)
    assert linededup.dedup_lines(frame.where("false")).count() == 0


def test_line_dedup_keeps_columns_of_any_name(spark):
    block = "\n".join(f"this is line number {k} of a passage in both" for k in range(5))
    rows = [(1, block + "\nown end", "a", 1, 2, 3), (2, "own start\n" + block, "b", 4, 5, 6)]
    frame = spark.createDataFrame(rows, ["doc_id", "text", "gone__", "k__", "a.b", "Lines_Removed"])
    out = linededup.dedup_lines(frame)
    assert out.columns == ["doc_id", "text", "gone__", "k__", "a.b", "lines_removed"]
    got = {r[0]: tuple(r) for r in out.collect()}
    assert got[1] == (1, rows[0][1], "a", 1, 2, [])
    assert got[2] == (2, "own start", "b", 4, 5, [1, 2, 3, 4, 5])
    for name in ("key", "found_key", "c0", "pos", "h", "w"):
        clash = linededup.dedup_lines(frame.select("doc_id", "text", frame["k__"].alias(name)))
        assert clash.columns == ["doc_id", "text", name, "lines_removed"] and clash.count() == 2


def test_a_line_of_many_documents_goes_from_all_but_the_first(spark):
    line = long(6, 60)
    frame = spark.range(400).selectExpr("id AS doc_id", f"concat('own ', id, '\n{line}\nmore ', id) AS text")
    out = linededup.dedup_lines(frame).collect()
    assert all((line in r.text) == (r.doc_id == 0) for r in out)


def test_a_passage_of_common_short_lines_is_found_past_their_first_holders(spark):
    lines = [f"w{k}a w{k}b w{k}c w{k}d w{k}e w{k}f w{k}g w{k}h w{k}i w{k}j" for k in range(5)]
    rows = [(10 * i + k, f"own {i} {k}\n{x}\nend {i} {k}") for i in range(12) for k, x in enumerate(lines)]
    rows += [(200 + i, f"start {i}\n" + "\n".join(lines) + f"\nstop {i}") for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.lines_removed for r in linededup.dedup_lines(frame).collect()}
    assert all(out[200 + i] == [1, 2, 3, 4, 5] for i in range(1, 30))
    assert all(not gone for d, gone in out.items() if d <= 200)


def test_blank_lines_end_no_passage(spark):
    lines = [long(20 + k, 10) for k in range(6)]
    rows = [(1, "own\n" + "\n\n".join(lines)), (2, "\n \t\n".join(["x", *lines, "y"])), (3, "\n".join(lines))]
    rows += [(10 + i, "\n\n\n".join([f"start {i}", *lines, f"stop {i}"])) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: (r.text, r.lines_removed) for r in linededup.dedup_lines(frame).collect()}
    assert out[1] == (rows[0][1], [])
    assert out[2] == ("x\n" + " \t\n" * 7 + "y", [2, 4, 6, 8, 10, 12])
    assert out[3] == ("", [0, 1, 2, 3, 4, 5])
    assert all(out[10 + i] == (f"start {i}\n" + "\n" * 14 + f"stop {i}", [3, 6, 9, 12, 15, 18]) for i in range(30))


def test_every_copy_of_a_passage_goes_from_a_later_document(spark):
    p, q = [long(40 + k, 10) for k in range(4)], long(50)
    rows = [
        (1, "\n".join(["own", *p, "between", q])),
        (2, "\n".join([q, *p, "x", *p, "y", q, q, *p[1:], "z", *p[:2]])),
        (3, "\n".join([*p, *p, *p])),
    ]
    out = {r.doc_id: r.lines_removed for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1] == []
    assert out[2] == [0, 1, 2, 3, 4, 6, 7, 8, 9, 11, 12, 13, 14, 15]
    assert out[3] == list(range(12))


def test_lines_go_if_and_only_if_an_earlier_document_has_a_long_run_with_them(spark):
    draw = random.Random(7)
    words = {h: f"w{h} " * draw.randint(2, 12) for h in range(9)}
    texts = []
    for d in range(60):
        lines = [draw.choice([*words.values(), "", f"own {d} {k}"]) for k in range(14)]
        texts.append("\n".join(lines))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.lines_removed for r in linededup.dedup_lines(frame).collect()}
    seen = set()
    for d, text in enumerate(texts):
        full = [(k, x) for k, x in enumerate(text.split("\n")) if x.strip()]
        own = [full[i:j] for i in range(len(full)) for j in range(i + 1, len(full) + 1)]
        own = [run for run in own if sum(len(x.split()) for _, x in run) >= 25]
        want = {k for run in own if tuple(x for _, x in run) in seen for k, _ in run}
        assert out[d] == sorted(want)
        seen |= {tuple(x for _, x in run) for run in own}
    assert any(out.values())


def test_a_passage_that_its_document_repeats_is_found():
    p = list(range(5))
    a, b = [90, *p, 91], [80, *p, 81, *p, 82]
    held = linededup.patience(a, b)
    assert [x for x, _ in held] == [1, 2, 3, 4, 5] and [b[y] for _, y in held] == p


@pytest.mark.parametrize("seed", range(5))
def test_two_documents_share_a_run_if_and_only_if_they_share_a_long_block(seed):
    draw = np.random.default_rng(seed)
    size = {h: int(draw.integers(1, 9)) for h in range(12)}
    shared = 0
    for _ in range(200):
        docs = [draw.integers(0, 12, 14) for _ in range(2)]
        docs = [(np.sort(draw.choice(18, 14, replace=False)), d) for d in docs]
        runs = [linededup.passages(p, d, np.array([size[h] for h in d]), 12) for p, d in docs]
        blocks = []
        for p, d in docs:
            own = ((i, j) for i in range(14) for j in range(i, 14) if p[j] - p[i] == j - i)
            blocks.append({tuple(d[i : j + 1]) for i, j in own if sum(size[h] for h in d[i : j + 1]) >= 12})
        assert bool(set(runs[0]) & set(runs[1])) == bool(blocks[0] & blocks[1])
        shared += bool(blocks[0] & blocks[1])
    assert 0 < shared < 200


@pytest.mark.parametrize("seed", range(5))
def test_patience_rises_and_matches(seed):
    draw = random.Random(seed)
    a = [draw.randint(0, 12) for _ in range(30)]
    b = a[5:20] + [draw.randint(0, 12) for _ in range(10)]
    found = linededup.patience(a, b)
    assert all(a[i] == b[j] for i, j in found)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:], strict=False))
    assert linededup.patience(a, a) == [(k, k) for k in range(30)] and linededup.patience(a, []) == []


def test_quality_is_learned_without_the_held_out_rows(spark, empty):
    draw = random.Random(0)
    good = [" ".join(draw.choices(["the", "cat", "sat", "on", "mats", "today."], k=40)) for _ in range(150)]
    bad = ["!!! ".join(draw.choices(["BUY", "NOW", "CHEAP"], k=40)) for _ in range(150)]
    rows = [(k, t) for k, t in enumerate(good + bad)] + [(None, good[0]), (900, None), (901, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0.5D AS score", "'a' AS y")
    marks = spark.createDataFrame([(k, int(k < 150)) for k in range(300)] + [(3, None), (None, 1)], "doc_id long, quality int")
    out = quality.classify(frame, marks).collect()
    assert len(out) == len(rows)
    for r in out:
        fold = r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.held_out == fold and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        if r.doc_id is not None and r.doc_id < 300:
            assert r.predicted == (r.doc_id < 150)
    none = quality.classify(frame, marks.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.classify(empty, marks).count() == 0


def test_isotonic_fit_rises_and_keeps_the_mean():
    weight, value = np.array([1.0, 2, 1, 4, 1]), np.array([0.1, 0.5, 0.2, 0.4, 0.9])
    fit = quality.isotonic(weight, value)
    assert (np.diff(fit) >= 0).all() and np.isclose((weight * fit).sum(), (weight * value).sum())
