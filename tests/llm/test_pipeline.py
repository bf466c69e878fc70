"""The stages of the corpus pipeline on a small table, and what the package may depend on."""

import random
import re
from pathlib import Path

import pyarrow as pa

import corpus_pipeline
from tidemark.llm import simhash
from tidemark.llm.queries import tokenizer
from tidemark.session import written

ROOT = Path(__file__).resolve().parents[2]
SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMALL)
        assert after.columns == columns, name
        path = corpus_pipeline.scratch_path(spark, "stage")
        after.write.parquet(path)
        before = spark.read.parquet(path)
        assert 0 < before.count()
    last = corpus_pipeline.STAGES[-1][1](spark, before, SMALL).collect()
    from tokenizers import Tokenizer
    reference = Tokenizer.from_str(tokenizer())
    texts = {r.text for r in before.collect()}
    assert len(last) == before.count() and {r.text for r in last} == texts
    assert all(list(r.ids) == reference.encode(r.text, add_special_tokens=False).ids for r in last)


def test_near_copies_go(spark):
    """Of documents whose fingerprints are linked at four bits or fewer the smallest stays; all others stay."""
    rnd = random.Random(17)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(900)]
    texts = []
    for i in range(60):
        base = [rnd.choice(words) for _ in range(rnd.choice([60, 200, 700]))]
        for j in range(5):
            copy = list(base)
            for at in rnd.sample(range(len(base)), j * len(base) // 200):
                copy[at] = rnd.choice(words)
            texts.append((10 * i + j, " ".join(copy).upper() if j == 3 else " ".join(copy)))
    texts += [(9000, None), (9001, ""), (9002, "one"), (9003, "One"), (None, "one"), (None, "no other")]
    prints = [simhash._fingerprint(simhash._hashes((t or "").encode(), 4)) for _, t in texts]
    label = list(range(len(texts)))

    def find(a):
        while label[a] != a:
            a = label[a]
        return a

    near = 0
    for a in range(len(texts)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                near += prints[a] != prints[b]
                label[find(a)] = find(b)
    assert near >= 20
    least = {}
    for a, (i, _) in enumerate(texts):
        old = least.get(find(a))
        least[find(a)] = i if old is None else old if i is None else min(i, old)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs = written(docs, "test-near")
    left = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted(least.values(), key=repr)


def test_clean_documents_stay(spark):
    """The classifier keeps what is labelled good and drops most of what is not."""
    kept = corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(f"{SMALL}/documents.parquet"), SMALL)
    marked = spark.read.parquet(f"{SMALL}/labels.parquet").join(
        kept.selectExpr("doc_id", "1 as stays"), "doc_id", "left").collect()
    good = [r.stays for r in marked if r.quality == 1]
    bad = [r.stays for r in marked if r.quality == 0]
    assert good.count(None) <= 0.02 * len(good) and bad.count(None) >= 0.6 * len(bad)


def test_nothing_else_imports_the_package():
    for file in (ROOT / "tidemark").rglob("*.py"):
        if "llm" not in file.parts:
            assert not re.search(r"tidemark\.llm|corpus_pipeline", file.read_text()), file


def test_stages_hand_texts_over_in_small_batches(spark):
    """A partition of 6 MB of text reaches the Python code of a stage some 2 MB at a time, none of it missing."""
    docs = written(spark.range(60).coalesce(1).selectExpr("id doc_id", "repeat('many words ', 10000) text"), "test-batches")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    stage = corpus_pipeline._stage(lambda spark, docs, _: docs.mapInArrow(sizes, "rows long, bytes long"))
    got = stage(spark, docs, SMALL).collect()
    assert sum(r.rows for r in got) == 60 and max(r.bytes for r in got) < 3e6
