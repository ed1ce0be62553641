"""The files of token ids, in the order of their names, are the array in ascending doc_id order."""

import random

import public_tokenizers
from pyspark.sql import functions as F

from lakemill.llm import id_store


def test_files_by_name_are_in_order(spark, tmp_path):
    draw = random.Random(4)
    numbered = [(draw.randrange(-10**6, 10**6), f"text number {k} " * (k % 9)) for k in range(400)] + [(None, "none"), (7, None), (7, "x")]
    docs = spark.createDataFrame(numbered, "doc_id long, text string").repartition(5)
    path = tmp_path / "ids"
    id_store.write_ids(docs, str(path), public_tokenizers.path("byte_bpe_50k.json"), parts=23, block_tokens=60)
    names = []
    for file in sorted(path.glob("part-*")):
        for block in id_store.blocks(file.read_bytes()):
            names += [block.doc_id(i) for i in range(block.n)]
    assert names == sorted((i for i, _ in numbered), key=lambda i: (i is not None, i or 0)) and len(list(path.glob("part-*"))) > 4
    read = id_store.read_ids(spark, str(path)).orderBy("start").select("doc_id", "start", "n_tokens").collect()
    assert [r.doc_id for r in read] == names and all(a.start + a.n_tokens == b.start for a, b in zip(read, read[1:]))
