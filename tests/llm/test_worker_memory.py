"""What a task leaves behind in its Python worker, which lives on beside those at work."""

import pyarrow as pa

from labelgraph.llm import queries as Q
from labelgraph.llm import token_blocks as TB


def test_tasks_leave_no_words_in_their_workers(spark):
    rows = [(i, " ".join(f"word{i}x{j} café İz{i}{j}" for j in range(40))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert TB.encode_documents(docs, Q.tokenizer_path(), Q.END_ID).count() == 80

    def held(batches):
        for _ in batches:
            own = TB._ENCODERS.values()
            yield pa.RecordBatch.from_arrays([pa.array([len(own)]), pa.array([sum(e.cache.used + len(e.chunks) for e in own)])], names=["encoders", "words"])

    found = spark.range(0, 8, 1, 8).mapInArrow(held, "encoders long, words long").collect()
    assert sum(r.encoders for r in found) > 0  # the same workers
    assert sum(r.words for r in found) == 0


def test_both_tokenizers_share_one_model_and_its_special_tokens():
    enc = TB.WordEncoder(Q.tokenizer_path())
    assert enc.plain.get_vocab() == enc.tok.get_vocab()
    added = enc.tok.get_added_tokens_decoder()
    for i, token in added.items():
        assert i in enc.plain.encode(f"a {token.content}", add_special_tokens=False).ids
