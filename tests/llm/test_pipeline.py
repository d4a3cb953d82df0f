"""The pipeline, stage by stage, against the plain versions of the other tests."""

from collections import Counter

import corpus_pipeline
from eventlens.llm.mixing import mix_sources
from eventlens.llm.packing import CAPACITY, tokenise
from eventlens.llm.toxicity import toxicity
from test_near_dedup import brute
from test_packing import check_packed

SF = "/root/testdata/sf0.001"
ROW = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*ROW).collect())


def test_stages(spark, sample, tmp_path):
    docs, seen = sample, []
    for name, stage in corpus_pipeline.STAGES:
        before, out = docs, stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append(name)
        if name != "packing":
            assert docs.columns == sample.columns
            had, has = rows_of(before), rows_of(docs)
        if name == "toxicity":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            toxic = {r.doc_id for r in toxicity(before, labels).collect() if r.predicted == 1}
            assert has == Counter({k: n for k, n in had.items() if k[0] not in toxic})
        elif name == "exact_dedup":
            largest = {}
            for d, text, *_ in had:
                largest[text] = max(largest.get(text, d), d)
            assert has == Counter({k: 1 for k in had if largest[k[1]] == k[0]})
        elif name == "near_dedup":
            kept = {d for d, _, _, k in brute([(k[0], k[1]) for k in had]) if k}
            assert has == Counter({k: n for k, n in had.items() if k[0] in kept})
        elif name == "mixing":
            copies = {r.doc_id: r.copies for r in mix_sources(before).collect()}
            assert has == Counter({k: copies[k[0]] for k in had if copies[k[0]]})
        else:
            packed = docs.collect()
            check_packed(packed, CAPACITY)
            key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
            assert Counter(map(key, packed)) == Counter(map(key, tokenise(before).collect()))
    assert seen == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
