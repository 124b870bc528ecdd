"""What Python workers keep from one operator to the next."""

import weakref

import public_tokenizers
import pyarrow as pa

from causeway.llm import near_dup
from causeway.llm.byte_bpe import ByteBpe


def test_near_duplicates_do_not_run_beside_the_words_of_the_token_file(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, None)], "doc_id long, text string")
    tasks, plain = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, *a: tasks.append(f) or plain(self, f, *a))
    assert near_dup.near_duplicates(docs).count() == 2 and len(tasks) >= 3
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        model = f.read()
    for task in tasks:
        coder = weakref.ref(ByteBpe.shared(model))
        assert coder() is ByteBpe.shared(model)  # tasks of the token file share it
        empty = pa.RecordBatch.from_pylist([], pa.schema([("key", pa.int64())]))
        list(task(iter([empty])))
        assert coder() is None
