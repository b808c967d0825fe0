"""Token alignment, the benchmark index and the Merkle manifest against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paperloom.llm import alignment, decontaminate, manifest
from tests.llm.fixtures import TEXTS, docs, empty

ODD = [
    (20, " " * 5000, "a"), (21, "a▁b", "a"), (22, "<|endoftext|> x </s> <0x0A>\n\x00é漢字\U0001F600", None), (23, "  two  spaces\n\n\ttab", "b"),
    (24, "y" * 3000, "b"), (None, "hello world", "c"), (None, None, "c"), (25, "ﬁ ①", "c"),
]
TABLE = TEXTS + ODD


def plain_alignment(rows):
    """By spans of bytes, text by text: doc_id and the contract's columns."""
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    slow.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
    held, out = [], []
    for _, text in rows:
        a = slow.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        x = [bytes(letters[c] for c in slow.id_to_token(i)) for i in a]
        y = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
        held.append((a, b, x, y) if text and b"".join(x) == b"".join(y) == (" " + text).encode() else ([], [], [], []))
    counts = Counter()
    for a, b, x, y in held:
        a_of, b_of = ([i for i, t in enumerate(ts) for _ in t] for ts in (x, y))
        links = sorted(set(zip(a_of, b_of)))
        counts.update({(a[i], b[j]) for i, j in links})
        a_ends, b_ends = (set(np.cumsum([len(t) for t in ts]).tolist()) for ts in (x, y))
        groups, at, i, j = [], 0, 0, 0
        for end in sorted(a_ends & b_ends):
            k, m = len({*a_of[:end]}), len({*b_of[:end]})
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            i, j, at = k, m, end
        out.append((links, groups))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    result = []
    for (doc, _), (a, b, _, _), (links, groups) in zip(rows, held, out):
        named = [(a[i], b[j]) for i, j in links]
        result.append((
            doc, len(a), len(b), len(groups), len(links), sum(g.split("|")[0].count(",") + 1 for g in groups for _ in range(g.split("|")[1].count(",") + 1)),
            sum(counts[p] == best[p[0]] for p in named), sum(counts[p] for p in named), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    return sorted(result, key=str)


@pytest.mark.parametrize("few", [alignment.FEW_PAIRS, 5])
def test_alignment(spark, few):
    rows = [(d, t if t is None or len(t) < 30_000 else t[:9000], s) for d, t, s in TABLE]
    got = alignment.alignment(docs(spark, rows), few_pairs=few).collect()
    assert sorted(map(tuple, got), key=str) == plain_alignment([(d, t) for d, t, _ in rows])
    assert alignment.alignment(empty(spark), few_pairs=few).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), max_size=5), max_size=8), st.lists(st.lists(st.integers(0, 4), max_size=4), min_size=7, max_size=7), st.integers(1, 9))
def test_products_equal_those_of_whole_matrices(a, b, most):
    def rows(lists, width):
        lists = [sorted(set(x)) for x in lists]
        dense = np.array([[int(c in x) for c in range(width)] for x in lists], np.int64).reshape(len(lists), width)
        return alignment.Rows(np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int64), np.array([c for x in lists for c in x], np.int64), width), dense

    x, p = rows(a, 7)
    y, q = rows(b, 5)
    out = np.zeros((len(a), 5), np.int64)
    for i, j, v in alignment.product(x, y, most):
        out[i, j] = v
    assert (out == p @ q).all()
    assert (alignment.n_products(x, y) == (p @ q).sum(axis=1)).all()
    back = alignment.transposed(x)
    assert [sorted(back.columns[s:e].tolist()) for s, e in zip(back.starts, back.starts[1:])] == [np.flatnonzero(c).tolist() for c in p.T]


def test_a_million_blanks_have_tokens(spark):
    pair = alignment.Pair()
    ids = pair.a_ids(" " * 1_000_001)
    assert b"".join(pair.a_bytes[i] for i in ids) == b" " * 1_000_001


ITEMS = [
    (1, "one fine line that opens the passage here and a second line that goes on"), (2, "then a third LINE ends it at last"), (2, "MIT license"), (3, None),
    (4, "  ,;. "), (None, "the mit license some more words follow here to make it"), (5, "words that stand nowhere in any of the texts at all today"),
    (6, "same line again and again same line again and again same"), (7, "x y z x y z x y z x y z"), (8, "follow here some more words that to make it ten"),
]


def plain_hits(rows, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        words = decontaminate.words_of((text or "").encode())
        many = min(window, len(words))
        for i in range(len(words) - many + 1 if words else 0):
            windows[tuple(words[i:i + many])].add("" if item is None else str(item))
    out = []
    for doc, text in rows:
        words, hit, ids = decontaminate.words_of((text or "").encode()), set(), set()
        for many in {len(w) for w in windows}:
            for i in range(len(words) - many + 1):
                if own := windows.get(tuple(words[i:i + many])):
                    ids |= own
                    hit.update(range(i, i + many))
        out.append((doc, len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("rarest", [1, 2, 3])
def test_benchmark_index(spark, rarest):
    items = spark.createDataFrame(ITEMS, "item_id int, text string").withColumn("row", F.lit("x"))
    got = decontaminate.contamination(docs(spark, TABLE), items, rarest=rarest).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=str) == plain_hits([(d, t) for d, t, _ in TABLE], ITEMS)
    assert {r.doc_id for r in got if "2" in r["items"]} >= {7, 8, 12, 13}
    # item 8 has the words of texts 7 and 8, in another order
    if rarest == 2:
        assert all(r.n_near >= 1 for r in got if r.doc_id in (7, 8))
        assert not any(r.n_near for r in got if r.doc_id in (5, 6, 10))
    assert decontaminate.contamination(empty(spark), items).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(docs(spark), items.limit(0)).collect())


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aB9 é,\n漢", max_size=30), max_size=6))
def test_terms_follow_words(texts):
    data = [t.encode() for t in texts]
    terms, counts = decontaminate.terms_of(data)
    words = [w for t in data for w in decontaminate.words_of(t)]
    assert counts.tolist() == [len(decontaminate.words_of(t)) for t in data]
    alone = {w: int(decontaminate.terms_of([w])[0][0]) for w in words}
    assert terms.tolist() == [alone[w] for w in words] and len(set(alone.values())) == len(alone)


def test_terms_of_words_beyond_the_tables():
    long = b"ab" * decontaminate.SPAN + b"c"
    (one,), _ = decontaminate.terms_of([long])
    both, counts = decontaminate.terms_of([b"x " + long + b" y", long[:-1]])
    assert both[1] == one != both[3] and counts.tolist() == [3, 1]


def plain_manifest(rows, fanout):
    digest = manifest.digest
    leaf = lambda r: digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    groups = defaultdict(list)
    for r in rows:
        tampered = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
        groups[r[2]].append((r[0] is None, r[0] or 0, leaf(r), leaf((*r[:3], r[3] + 1, r[4])) if tampered else leaf(r)))

    def proofs(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([digest("".join(levels[-1][i:i + fanout])) for i in range(0, len(levels[-1]), fanout)])
        out = []
        for i in range(len(nodes)):
            proof = []
            for level in levels[:-1]:
                run = i - i % fanout
                proof.append((level[run:i], level[i + 1:run + fanout]))
                i //= fanout
            out.append(proof)
        return levels[-1][0], out

    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    own = {g: proofs([x[2] for x in sorted(groups[g])]) for g in names}
    root, upper = proofs([own[g][0] for g in names])
    out = []
    for g, above in zip(names, upper):
        for x, proof in zip(sorted(groups[g]), own[g][1]):
            node = x[3]
            for a, b in proof + above:
                node = digest("".join([*a, node, *b]))
            listed = "".join("".join([*a, *b]) for a, b in proof + above)
            out.append((None if x[0] else x[1], x[2], own[g][0], root, digest(listed), node, node == root))
    return sorted(out, key=str)


@pytest.mark.parametrize(("part_levels", "round_levels", "fanout"), [(12, 4, 2), (0, 1, 2), (1, 2, 2), (1, 1, 3)])
def test_manifest(spark, part_levels, round_levels, fanout):
    langs = [None, "", "de", "en", "é", "en", "en"]
    rows = [(d, s, langs[i % 7], None if i % 5 == 0 else len(t or ""), t) for i, (d, t, s) in enumerate(TABLE * 2)]
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    table = table.select("*", *[F.lit("x").alias(c) for c in ("leaf", "group", "part", "at", "rows", "height")])
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    got = manifest.manifest(table, tampered, fanout, part_levels, round_levels).collect()
    assert sorted(map(tuple, got), key=str) == plain_manifest(rows, fanout)
    assert {r.verified for r in got} == {True, False}
    assert manifest.manifest(table.limit(0), tampered, fanout, part_levels, round_levels).count() == 0
    alone = manifest.manifest(table.limit(1)).collect()[0]
    assert alone.verified and alone.leaf == alone.root and alone.proof_sha256 == manifest.digest("")
