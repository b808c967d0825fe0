"""The pipeline's stages on one another, against plain Python on a small table."""

import re

import corpus_pipeline
from tests.llm.fixtures import TEXTS, docs, empty
from tests.llm.test_packing import reference
from tests.llm.test_texts import plain_dedup

SPACES = r"[^\x20\x09-\x0D]+"


def plain_stages(rows):
    """Quality, line dedup and near duplicates by brute force: doc_id -> text."""
    kept = []
    for d, text, source in rows:
        words = re.findall(SPACES, text or "")
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        inside = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)} if len(grams) < 5000 else set()
        if len(words) >= 10 and 100 * len(inside) <= 20 * len(words):
            kept.append((d, text, source))
    cut = []
    rows = sorted(set(kept), key=lambda r: (r[0] is None, r[0]))
    for (d, text, source), (_, _, left, n, gone) in zip(rows, plain_dedup(rows)):
        if left or not gone:
            cut += [(d, left, source)] * kept.count((d, text, source))
    out = {}
    for d, text, source in cut:
        words = re.findall(SPACES, "".join(c.lower() if c.isascii() else c for c in text))
        own = {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}
        for other, _ in out.values():
            if 100 * len(own & other) >= 80 * len(own | other):
                break
        else:
            out[d] = (own, text)
    return {d: t for d, (_, t) in out.items()}


def test_stages(spark, tmp_path):
    table = docs(spark)
    table.write.parquet(str(tmp_path / "documents.parquet"))
    read = spark.read.parquet(str(tmp_path / "documents.parquet"))
    frame = read
    for name, stage in corpus_pipeline.STAGES[:3]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == read.columns, name
    got = {r.doc_id: r.text for r in frame.collect()}
    assert got == plain_stages(TEXTS)
    mixed = corpus_pipeline.STAGES[3][1](spark, frame, str(tmp_path))
    assert mixed.columns == read.columns
    rows = mixed.collect()
    assert all(got[r.doc_id].startswith(r.text) for r in rows) and all(r.n_chars == len(r.text) for r in rows)
    tokenizer = reference()
    want = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in rows)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sum(r.length for r in packed) == want


def test_clashing_names_pass_line_dedup(spark, tmp_path):
    names = dict(zip(("size", "words", "key", "label", "n"), ("row", "drop", "OF", "n_lines", "n_removed_lines")))
    table = docs(spark).withColumnsRenamed(names)
    out = corpus_pipeline.line_dedup(spark, table, str(tmp_path))
    assert out.schema == table.schema
    plain = corpus_pipeline.line_dedup(spark, docs(spark), str(tmp_path))
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.withColumnsRenamed(names).collect()))


def test_empty_table(spark, tmp_path):
    empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
