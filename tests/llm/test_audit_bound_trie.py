"""Source divergence, bound-certified packing and the prefix trie against their definitions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from compare import SF_SMALL
from shipping import shipped  # noqa: F401
from tidegate.llm import boundpack, divergence, trie
from tidegate.llm.queries import QUERIES
from tidegate.llm.tokens import encoder
from tokenizers import Tokenizer

WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "\n\n", "Ünïcode ﬁ İx Σας", "<|endoftext|>a", "it's I'LL", "a" * 30_000, "x " * 9_000, "日本 語 été", "é\x85b\x1cc"]


# ---------------------------------------------------------------- packing


def _least_bins(lengths, room):
    best = len(lengths)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b >= lengths[i]}.values():
            go(i + 1, [b - lengths[i] * (j == k) for j, b in enumerate(bins)])
        go(i + 1, [*bins, room - lengths[i]])

    go(0, [])
    return best


def test_bound_and_best_fit_against_search():
    draw = random.Random(3)
    for _ in range(400):
        room = draw.choice([7, 10, 33, 100])
        lengths = [draw.randint(1, room) for _ in range(draw.randint(1, 8))]
        found = boundpack.best_fit_decreasing(np.array(lengths), room)
        free = []
        for x in sorted(lengths, reverse=True):
            fits = [(f, k) for k, f in enumerate(free) if f >= x]
            k = min(fits)[1] if fits else len(free)
            free = free if fits else [*free, room]
            free[k] -= x
        assert sorted(room - np.bincount(found, lengths)) == sorted(free)
        bound = boundpack.lower_bound(np.bincount(lengths, minlength=room + 1), room)
        assert bound <= _least_bins(sorted(lengths, reverse=True), room) <= len(free)


def test_bound_sees_what_the_volume_does_not():
    lengths = np.full(100, 1400)
    assert boundpack.lower_bound(np.bincount(lengths, minlength=4097), 4096) == 50
    assert boundpack.lower_bound(np.zeros(4097, int), 4096) == 0


def test_word_ids_equal_the_library():
    fast, slow = encoder(WORDS, None), Tokenizer.from_file(WORDS)
    assert fast.fast is not None
    draw = random.Random(7)
    signs = "abcdeABCéüñßİŉǅ'’.,-0123²½µ\t ́Σσς日\x1c\x85 \n"
    words = [t.removesuffix("</w>") for t in slow.get_vocab()]
    odd = ["".join(draw.choices(signs, k=draw.randint(0, 30))) for _ in range(3000)]
    odd += [" ".join(draw.choices(words, k=20)) for _ in range(2000)] + [t or "" for t in ODD]
    for text in odd:
        assert np.frombuffer(fast.encode(text), "<u4").tolist() == slow.encode(text, add_special_tokens=False).ids


def _check_packing(rows, docs, max_len):
    slow = Tokenizer.from_file(WORDS)
    want = Counter()
    for doc, text in docs:
        ids = np.array([*slow.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(-(-len(ids) // max_len)):
            own = ids[k * max_len : (k + 1) * max_len]
            want[doc, k, k * max_len, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= max_len
    return len(sequences)


def test_packing_keeps_every_id_and_meets_its_bound(spark):
    draw = random.Random(2)
    docs = [*enumerate(ODD), (None, "a b"), (3, None), (3, "same id"), (7, "same id")]
    docs += [(k, "word " * draw.randint(0, 300)) for k in range(100, 700)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as `grp`", "2 as `Bin`", "3 as `a.b`", "4 as `_to`")
    packed = boundpack.pack(frame.repartition(7), WORDS, batch_pieces=50, exchange_pieces=200)
    rows = packed.collect()
    used = _check_packing(rows, docs, 4096)
    assert boundpack.certificate(packed) == (used, used)


def test_packing_of_many_short_texts_fills_sequences(spark):
    docs = [(k, "") for k in range(20_000)]
    packed = boundpack.pack(spark.createDataFrame(docs, "doc_id long, text string").repartition(16), WORDS)
    assert _check_packing(packed.collect(), docs, 4096) == 5


def test_packing_of_nothing(spark):
    assert boundpack.pack(spark.createDataFrame([], "doc_id long, text string"), WORDS).collect() == []


def test_packing_hands_out_ids(spark):
    docs = spark.createDataFrame([(1, "hello world " * 3000), (2, None)], "doc_id long, text string")
    for r in boundpack.pack(docs, WORDS, with_ids=True).collect():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length


# ---------------------------------------------------------------- divergence


def _audit(rows, min_docs=3, top=200):
    one = 10**9
    docs = [tuple("" if x is None else x for x in r) for r in rows]
    use, having = defaultdict(Counter), defaultdict(Counter)
    groups = {(lang, source) for lang, source, _ in docs}
    for lang, source, text in docs:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        use[lang, source].update(words)
        having[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = {t for t, n in having[lang].items() if n >= min_docs}
        sources = sorted(s for x, s in groups if x == lang)
        total, p = Counter(), {}
        for s in sources:
            own = {t: use[lang, s][t] for t in kept}
            total.update(own)
            size = sum(own.values()) + len(kept)
            p[s] = {t: 1 + one * (n + 1) // size for t, n in own.items()}
        size = sum(total.values()) + len(kept)
        q = {t: 1 + one * (total[t] + 1) // size for t in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(x, sum(f(p[s][t], p[x][t]) for t in kept)) for x in sources if x != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if use[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(found[:most], 1)]
    return sorted(out)


def test_divergence_against_its_definition(spark):
    draw = random.Random(4)
    words = ["the", "The", "été", "ÉTÉ", "x1y", "日本", "a-b", "ZZ", "q", "rare", "z" * 40]
    rows = []
    for _ in range(300):
        text = " ".join(draw.choices(words, weights=[9, 5, 4, 2, 3, 3, 2, 2, 1, 1, 1], k=draw.randint(0, 12)))
        rows.append((draw.choice(["en", "de", None, ""]), draw.choice(["a", "b", "c", None, "D"]), draw.choice([text, None, "", "same text"])))
    rows += [("en", "a", "copied words copied")] * 40 + [("en", "b", "copied words copied")] * 2
    rows += [("xx", "lonely", "few"), ("xx", "other", None), ("yy", "alone", "w " * 200_000)]
    frame = spark.createDataFrame(rows, "lang string, source string, text string")
    frame = frame.selectExpr("*", "1 as `n`", "2 as `digest`", "3 as `a.b`", "'t' as `term`")
    got = [tuple(r) for r in divergence.audit(frame, top=4).collect()]
    assert sorted(got) == _audit(rows, top=4)


def test_divergence_sums_pairs_in_bounded_pieces(spark, monkeypatch):
    monkeypatch.setattr(divergence, "PAIRS", 7)
    monkeypatch.setattr(divergence, "ENTRIES", 3)
    rows = [("l", f"s{k % 9}", f"w{chr(97 + k % 5)} common {'x' * (k % 3)}") for k in range(60)]
    spark_rows = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(map(tuple, divergence.audit(spark_rows).collect())) == _audit(rows)


def test_divergence_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(empty).collect() == []
    one = spark.createDataFrame([("en", "a", None)], "lang string, source string, text string")
    assert divergence.audit(one).collect() == []


# ---------------------------------------------------------------- trie


def _nodes(sequences):
    """All nodes of `{conv_id: [(role, text)]}` by walking every prefix."""
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for key in members:
        if key:
            kids[key[:-1]].append(key)
    out = []

    def walk(key):
        leaves, saved = 0, 0
        for k in kids[key]:
            a, b = walk(k)
            leaves, saved = leaves + a, saved + b
        own = sorted(members[key])
        saved += (len(own) - 1) * len(key[-1][1]) if key else 0
        leaves = leaves or 1
        ends = ",".join(str(c) for c in own if len(sequences[c]) == len(key))
        parent = min(members[key[:-1]]) if key else None
        out.append((own[0], len(key), parent, len(own), len(kids[key]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if sequences:
        walk(())
    return sorted(out, key=str)


def _read(rows):
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            found[c].append((turn is not None, turn or 0, len(text or ""), role or "", text or ""))
    return {c: [x[3:] for x in sorted(turns)] for c, turns in found.items()}


def _rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        out[c] = head[:h] + turns[h:]
    return out


def _conversations(seed, n, longest):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(1000), n):
        for k in range(draw.randint(1, longest)):
            rows.append((c, k, draw.choice(["user", "user", None]), draw.choice(["a", "bb", "ccc", "日本", None, ""])))
    rows += [(5001, None, "user", "null turn first"), (5001, 0, "user", "then"), (None, 0, "user", "nobody's")]
    rows += [(-7, 0, "x", "neg"), (7000, 0, "s", "l" * 50_000), (7001, 0, "s", "l" * 50_000)]
    draw.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize(("n", "longest", "block"), [(250, 9, 4), (40, 30, 3)])
def test_trie_against_walking_all_prefixes(spark, n, longest, block):
    rows = _conversations(n, n, longest)
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as `pos`", "2 as `chars`", "3 as `a.b`", "4 as `key`")
    turns = trie.numbered(table)
    own = _read(rows)
    got = trie.prefix_trie(*trie.with_shared_heads(turns), block=block).collect()
    assert sorted(map(tuple, got), key=str) == _nodes(_rebuilt(own))
    members = spark.createDataFrame([(c, len(t)) for c, t in own.items()], "conv_id long, n_turns long")
    got = trie.prefix_trie(turns.join(members, "conv_id"), members, block=block).collect()
    assert sorted(map(tuple, got), key=str) == _nodes(own)


def test_trie_of_one_long_and_many_equal_conversations(spark):
    rows = [(1, k, "u", f"t{k % 7}") for k in range(3000)]
    rows += [(c, k, "u", f"t{k}") for c in range(100, 400) for k in range(6)]
    turns = trie.numbered(spark.createDataFrame(rows, SCHEMA))
    sizes = [(1, 3000), *((c, 6) for c in range(100, 400))]
    members = spark.createDataFrame(sizes, "conv_id long, n_turns long")
    got = trie.prefix_trie(turns.join(members, "conv_id"), members).collect()
    import sys

    sys.setrecursionlimit(20_000)
    assert sorted(map(tuple, got), key=str) == _nodes(_read(rows))


def test_trie_joins_lists_from_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "LIST_PIECE", 7)
    rows = [(c, 0, "u", "same") for c in range(90)]
    turns = trie.numbered(spark.createDataFrame(rows, SCHEMA))
    members = spark.createDataFrame([(c, 1) for c in range(90)], "conv_id long, n_turns long")
    got = trie.prefix_trie(turns.join(members, "conv_id"), members).collect()
    assert sorted(map(tuple, got), key=str) == _nodes(_read(rows))


def test_trie_of_nothing(spark):
    turns = trie.numbered(spark.createDataFrame([], SCHEMA))
    assert trie.prefix_trie(*trie.with_shared_heads(turns)).collect() == []


def test_bound_packing_query_covers_the_table(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()
    _check_packing(QUERIES["op12_bound_packing"](spark, SF_SMALL).collect(), docs, 4096)
