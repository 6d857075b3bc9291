"""The pipeline against plain versions of its stages."""
import re
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from innspark.llm import mixing
from innspark.llm.common import written
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_minhash import brute as components

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"test-{name}")
        out[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    # language: nothing with letters goes from this sample
    first = spark.read.parquet(f"{SF}/documents.parquet").collect()
    letters = {r.doc_id for r in first if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in out["language"]} == letters
    # near-duplicates: the smallest doc_id of each component
    wanted = {d for d, _, c in components([(r.doc_id, r.text) for r in out["language"]], k=5) if d == c}
    assert {r.doc_id for r in out["near_duplicates"]} == wanted
    # benchmark
    hit = {d for d, *_, bad in contaminated([(r.doc_id, r.text) for r in out["near_duplicates"]], bench) if bad}
    assert {r.doc_id for r in out["benchmark"]} == wanted - hit
    # mix: each source near its target, no document more than twice
    size = {r.doc_id: (r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text))) for r in out["benchmark"]}
    sizes, taken, copies = defaultdict(int), defaultdict(int), defaultdict(int)
    for source, n in size.values():
        sizes[source] += n
    for r in out["mix"]:
        copies[r.doc_id] += 1
        taken[r.source] += size[r.doc_id][1]
    target = mixing.targets(sizes)
    assert max(copies.values()) <= 2 and set(copies) <= set(size)
    least = {s: max(n for t, n in size.values() if t == s) for s in sizes}
    assert all(abs(taken[s] - target[s]) <= least[s] for s in sizes)
    # tokens: the library's ids of each copy, one after another
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counts = sorted((r.doc_id, len(plain.encode(r.text, add_special_tokens=False).ids) + 1) for r in out["mix"])
    rows = sorted(out["tokens"], key=lambda r: r.start)
    assert [(r.doc_id, r.n_tokens) for r in rows] == counts
    assert [r.start for r in rows] == [sum(n for _, n in counts[:k]) for k in range(len(counts))]


def test_odd_rows(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"odd-{name}")
    assert docs.count() >= 1
    docs = docs_of([])
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"empty-{name}")
    assert docs.count() == 0
