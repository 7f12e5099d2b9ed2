"""The corpus pipeline against a plain version of its stages."""

import zlib

import numpy as np
from llm_texts import prose
from pyspark.sql import functions as F

from tidal.llm import mixing as MX
from tidal.llm import toxicity as TX
from tidal.llm.common import fold


def shingles(text):
    w = text.lower().split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_pipeline_against_plain_stages(spark, tmp_path):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer
    item = " ".join(prose(77, 60).split()[10:30])
    base = prose(1, 80)
    texts = {k: prose(k, 60 + k) for k in range(10, 29)} | {
        1: base, 2: base, 3: base.replace(base.split()[40], "changed", 1), 4: item, 5: None,
        6: prose(6, 900) + " " + item + " " + prose(8, 50), 7: "You idiot, you stupid moron. You pathetic loser."}
    sf = str(tmp_path)
    rows = [(k, t, "en", "ab"[k % 2]) for k, t in sorted(texts.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(k, int(k == 7)) for k in texts], "doc_id long, toxic int")
    docs.write.parquet(f"{sf}/documents.parquet")
    labels.write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([("i", item)], "item_id string, text string").write.parquet(f"{sf}/benchmark.parquet")

    model = TX.learn(docs, labels, fold("doc_id", 3) != 1)
    toxic = {r["doc_id"] for r in TX.score_toxicity(docs, model).where("predicted = 1").collect()}
    left = {k: t or "" for k, t in texts.items() if k not in toxic}
    for a in sorted(left):  # links of this fixture join pairs with the smallest id
        sa = shingles(left.get(a, ""))
        for b in [b for b in sorted(left) if a in left and b > a and sa]:
            sb = shingles(left[b])
            if 100 * len(sa & sb) >= 75 * len(sa | sb):
                del left[b]
    assert 1 in left and 2 not in left and 3 not in left
    del left[4]  # all of it is the benchmark's
    at = left[6].index(item)
    left[6] = left[6][:at] + left[6][at + len(item):]
    clean = spark.createDataFrame([(k, t, "ab"[k % 2]) for k, t in left.items()], "doc_id long, text string, source string")
    copies = {r["doc_id"]: r["copies"] for r in MX.mix(clean).where("copies > 0").collect()}
    tok, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for k in sorted(copies):
        ids = np.array(tok.encode(left[k], add_special_tokens=False).ids + [0], "<u4")
        for _ in range(copies[k]):
            want.append((k, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    got = corpus_pipeline.run(spark, sf).select("doc_id", F.col("start"), "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want
