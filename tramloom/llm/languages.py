"""Language identification by prediction by partial matching: the language whose context tree codes a text shortest.

The trees are fitted on the driver to a bounded sample: pieces of PIECE characters, chosen by a hash from all places of
the whole texts of labelled rows, about SAMPLE_CHARS in all and as much of each language as there is, up to an equal
share. The MOST languages with the most rows are learnt. The broadcast trees are bounded by the sample. Every document's
bytes (A-Z lower-cased, so that capitals don't look foreign) are then coded whole, in all languages at once; a language's
bits for its share of the labelled rows are added, which decides where a text says little.

Defined results: null, empty and letterless texts are ``und`` with score 0, and so are all if no language can be learnt;
the score is the share of the predicted language in the sum of all languages' probabilities of the text; ties go to the
smaller name. Rows with a null or empty text or a null language teach nothing. A repeated row gets its like's result.
Columns of the input named lang_pred or score give way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramloom.llm.common import OWN, binary, col, map_rows, slices, without
from tramloom.llm.ppm import ORDER, START, Trees

#: Characters of the sample in all and of a piece; languages that are learnt.
SAMPLE_CHARS, PIECE, MOST = 4_000_000, 1_000, 32
UNKNOWN = "und"


def learn_sample(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample_chars: int = SAMPLE_CHARS, piece: int = PIECE, most: int = MOST) -> dict[str, list[bytes]]:
    """Pieces of text by language, in the order of names; the same for the same rows. At most sample_chars / languages each, give or take the luck of hashes, cut at half as much again."""
    rows = docs.where(col(lang).isNotNull() & (F.length(col(text)) > 0)).select(col(lang).cast("string").alias("lang"), col(text).alias("text"), F.xxhash64(col(key), col(text)).alias("h"))
    known = rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.ceil(F.length("text") / piece)).alias("pieces")).orderBy(F.desc("n"), "lang").limit(most).collect()
    if not known:
        return {}
    wanted = max(1, sample_chars // (piece * len(known)))
    share = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, wanted / r["pieces"])) for r in known], "lang string, share double")
    chosen = lambda i: F.pmod(F.xxhash64("h", i), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    places = F.filter(F.sequence(F.lit(0), F.ceil(F.length("text") / piece).cast("int") - 1), chosen)
    cut = F.transform(places, lambda i: F.struct(F.xxhash64("h", i, F.lit(1)).alias("order"), F.substring(F.col("text"), i * piece + 1, F.lit(piece)).alias("piece")))
    found = rows.join(F.broadcast(share), "lang").select("lang", F.explode(cut).alias("p")).select("lang", "p.*").orderBy("order", "lang", "piece").limit(math.ceil(1.5 * wanted * len(known))).toArrow()
    out: dict[str, list[bytes]] = {r["lang"]: [] for r in sorted(known, key=lambda r: r["lang"])}
    for name, x in zip(found.column("lang").to_pylist(), found.column("piece").to_pylist(), strict=True):
        if len(out[name]) < 1.5 * wanted:
            out[name].append(x.encode())
    return out


def predict_languages(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", trained: Column | None = None, order: int = ORDER, sample_chars: int = SAMPLE_CHARS, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs with the predicted language and its score (0 to 1) added; learnt from rows where ``trained`` holds, by default all with a language."""
    sample = learn_sample(docs if trained is None else docs.where(trained), text, lang, key, sample_chars)
    docs = without(docs, *names)
    known = [x for x in sample if sample[x]]
    if not known:
        return docs.select("*", F.lit(UNKNOWN).alias(names[0]), F.lit(0.0).alias(names[1]))
    lead = START * order
    trees = Trees([lead.join(sample[x]).lower() for x in known], order)
    size = np.array([sum(map(len, sample[x])) for x in known], float)
    prior = -np.log2(size / size.sum())
    shared = docs.sparkSession.sparkContext.broadcast((trees, prior, known))
    kept, letters = docs.columns, f"{OWN}letters"
    marked = docs.withColumn(letters, F.coalesce(col(text).rlike(r"\p{L}"), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, prior, known = shared.value
        labels = np.array([*known, UNKNOWN], object)
        for b in slices(batches, 500):
            fine = b.column(letters).to_numpy(zero_copy_only=False)
            bits = trees.text_bits([t.lower() for t in binary(b, text)]) + prior
            best = np.where(fine, bits.argmin(1), len(known))
            score = np.where(fine, 1 / np.exp2(np.maximum(bits.min(1)[:, None] - bits, -1000)).sum(1), 0.0)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(labels[best], pa.string()), pa.array(score)], names=[*kept, *names])

    return map_rows(marked, run, kept, {names[0]: "string", names[1]: "double"})
