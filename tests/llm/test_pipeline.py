"""The pipeline, stage by stage, against the operators' rules read plainly."""

import re
from collections import Counter

import numpy as np

import corpus_pipeline as P
from routelake.llm import mixing, queries

SF = "/root/testdata/sf0.001"


def test_stages_follow_from_each_other(spark):
    from tokenizers import Tokenizer

    docs = queries.table(spark, SF, "documents").cache()
    seen = [docs]
    for _, stage in P.STAGES:
        seen.append(stage(spark, seen[-1], SF).cache())
    assert all(d.columns == P.COLUMNS for d in seen[:-1])
    first, good, lined, apart, mixed, coded = (d.collect() for d in seen)
    assert {r.doc_id for r in good} < {r.doc_id for r in first} and {(r.doc_id, r.text) for r in good} <= {(r.doc_id, r.text) for r in first}
    before = {r.doc_id: r.text for r in good}
    for r in lined:  # lines go, none comes or moves
        old = iter(before[r.doc_id].split("\n"))
        assert all(any(x == y for y in old) for x in r.text.split("\n")) and r.n_chars == len(r.text)
    long_lines = Counter(x.strip(" \t\r\v\f") for r in lined for x in r.text.split("\n") if len(x.strip(" \t\r\v\f")) >= 30)
    assert set(long_lines.values()) == {1}
    assert {r.doc_id for r in apart} <= {r.doc_id for r in lined} and len({r.text for r in apart if r.text.split()}) == len([r for r in apart if r.text.split()])
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in apart}
    copies = Counter(r.doc_id for r in mixed)
    assert set(copies) <= set(size) and max(copies.values()) <= 3
    total = sum(size.values())
    assert abs(sum(size[r.doc_id] for r in mixed) - total) <= 20 * max(size.values())
    reference, text = Tokenizer.from_file(queries.tokenizer("word_bpe_49k.json")), {r.doc_id: r.text for r in apart}
    assert Counter(r.doc_id for r in coded) == copies
    for r in coded:
        assert bytes(r.ids) == np.array(reference.encode(text[r.doc_id], add_special_tokens=False).ids, "<u4").tobytes()


def test_run_gives_the_stages_rows(spark):
    docs = queries.table(spark, SF, "documents")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    key = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, P.run(spark, SF).select(key).collect())) == sorted(map(tuple, docs.select(key).collect()))


def test_rows_that_share_an_id_are_kept_and_mixed_by_themselves(spark):
    """Rows repeated under one id, null ids, one id with different texts."""
    prose = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(6)]
    data = [(1, prose[0], "en", "a", 1)] * 3 + [(1, prose[1], "en", "a", 1), (None, prose[2], "en", "b", 1), (None, prose[3], "en", "b", 1), (None, prose[3], "de", "b", 1), (2, prose[4], "en", "b", 1), (3, prose[4], "en", "a", 1), (None, prose[4], "en", "a", 1), (4, " ", "en", "c", 1), (4, " ", "en", "c", 1), (5, None, None, None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    apart = P.drop_near_copies(spark, docs, SF)
    want = [data[0], data[3], data[4], (None, prose[3], "de", "b", 1), data[7], *data[10:]]
    assert Counter(map(tuple, apart.collect())) == Counter(want)
    for rows in (docs, apart):
        before = Counter(map(tuple, rows.collect()))
        taken = Counter()
        for r in mixing.mix(rows).collect():
            taken[r.doc_id, r.source] += r.reps
        mixed = Counter(map(tuple, P.mix_sources(spark, rows, SF).collect()))
        by_id = Counter()
        for r, n in mixed.items():
            assert n <= 3 * before[r]
            by_id[r[0], r[3]] += n
        assert +by_id == +taken and by_id
