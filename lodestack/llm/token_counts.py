"""Token counts by a two-tier table of piece lengths, without a shuffle of pieces.

*Frequent pieces.* The table is fitted on a bounded sample: the whole texts of about ``SAMPLE_ROWS`` rows, drawn
at random. ``SAMPLE_TASKS`` tasks count their pieces, each in a summary of at most ``per_task`` of them, and the driver
adds these up. The ``table_size`` most frequent pieces are broadcast with their token counts. Neither the sample,
nor what the driver receives, nor the table grows with the corpus.

*Counts.* One pass over all texts, whole: a task looks up the distinct pieces of its texts in the
table; those that miss it go to the worker's own cache, and from there to the tokenizer
library. Counts are exact whatever the table holds, and no piece leaves its task.

Defined results: a null text counts as empty, with no tokens. Rows may repeat and ids may be
null and of any type; every row gives one row. The sample of an empty table is empty, and every
piece misses. Texts of any length are counted whole, about four MB of texts at a time. Other
input columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .bpe import PieceEncoder, Pieces, load_tokenizer, text_slices
from .shared import quoted

#: Rows that the frequent pieces are taken from, and tasks that count them.
SAMPLE_ROWS, SAMPLE_TASKS = 4_096, 32


def _summaries(batches, path: str, size: int):
    encoder, seen = PieceEncoder.of_worker(path), Counter()
    for batch in batches:
        for _, texts in text_slices(batch.column(0)):
            p = Pieces(texts, encoder.specials)
            seen.update(dict(zip(p.distinct, np.bincount(p.codes, minlength=len(p.distinct)).tolist(), strict=True)))
    top = seen.most_common(size)
    yield pa.RecordBatch.from_pydict({"pieces": [[x for x, _ in top]], "counts": [[n for _, n in top]]})


def frequent_pieces(docs: DataFrame, tokenizer_path: str, table_size: int = 16_384, per_task: int = 8_192, text_col: str = "text") -> dict[str, int]:
    """The token count of each of at most ``table_size`` pieces that are frequent in a bounded sample of ``docs``."""
    texts = docs.select(F.col(quoted(text_col)))
    share = SAMPLE_ROWS / max(1, texts.count())
    drawn = texts if share >= 1 else texts.sample(fraction=share, seed=7)
    summaries = drawn.repartition(SAMPLE_TASKS).mapInArrow(partial(_summaries, path=tokenizer_path, size=per_task), "pieces array<string>, counts array<long>")
    total = Counter()
    for row in summaries.collect():  # SAMPLE_TASKS rows
        for x, n in zip(row["pieces"], row["counts"], strict=True):
            total[x] += n
    encoder = PieceEncoder(tokenizer_path)
    names = [x for x, _ in total.most_common(table_size)]
    return dict(zip(names, encoder.lengths[encoder.slots_of(names)].tolist(), strict=True)) if names else {}


def _counts(batches, path: str, table):
    encoder, frequent = PieceEncoder.of_worker(path), table.value
    for batch in batches:
        texts = batch.column(1)
        n = np.zeros(len(texts), np.int64)
        for at, part in text_slices(texts):
            n[at : at + len(part)] = encoder.count_slice(part, frequent)
        size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(n)], ["id", "n_bytes", "n_tokens"])
    encoder.release()


def _other_counts(batches, path: str):
    """For tokenizers without byte-level pieces: every text by its library."""
    if path.endswith(".model"):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda texts: [len(x) for x in library.encode(texts, num_threads=1)]
    else:
        library = load_tokenizer(path)
        count = lambda texts: [len(x.ids) for x in library.encode_batch_fast(texts, add_special_tokens=False)]
    for batch in batches:
        texts = batch.column(1)
        n = [k for _, part in text_slices(texts, 1 << 20) for k in count(part.to_pylist())]
        size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer_path: str, table_size: int = 16_384, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row."""
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])
    rows = docs.select(F.col(quoted(id_col)), F.col(quoted(text_col)))
    if tokenizer_path.endswith(".json") and type(load_tokenizer(tokenizer_path).pre_tokenizer).__name__ == "ByteLevel":
        table = docs.sparkSession.sparkContext.broadcast(frequent_pieces(docs, tokenizer_path, table_size, text_col=text_col))
        work = partial(_counts, path=tokenizer_path, table=table)
    else:
        work = partial(_other_counts, path=tokenizer_path)
    return rows.mapInArrow(_named(work, id_col), schema)


def _named(work, id_col: str):
    def run(batches):
        for batch in work(batches):
            yield batch.rename_columns([id_col, *batch.schema.names[1:]])

    return run
