"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept.  ``run`` writes each stage's result to the shared folder and reads it back
as the next one's input, so a lost executor costs at most the stage at work.

1. toxicity: documents that score as toxic go
2. near_duplicates: one document of each SimHash class stays
3. decontamination: documents with a benchmark passage go
4. pii: personal numbers, dates and addresses get format-preserving pseudonyms
5. packing: the documents are tokenised and packed into sequences

For every stage: an empty table gives no rows and a table of the same columns (the last
stage: of its own); texts of any length are handled whole; columns beside doc_id and text,
whatever their names, stay as they are in all but the last stage, which leaves them out.
What a stage does with NULLs, ties and repeated rows stands at its function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm import decontaminate, packing, pii, simhash, toxicity
from terrane.llm.common import table, written
from terrane.llm.queries import pii_key, tokenizer_path
from terrane.session import remove_scratch, scratch_scope


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows of this stage's own input that are not held out, then scores every row.

    NULL, empty and wordless texts score 0 and stay, as do rows without a doc_id; a score of exactly the
    threshold goes; repeated rows score alike and stay or go together.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), only=~toxicity.held_out(F.col("doc_id")))
    return toxicity.drop_toxic(docs, model)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates stays: the one of the smallest doc_id.  Of rows that repeat that id in the class, any one.

    NULL, empty and wordless texts have fingerprint zero and are one class; repeated rows are of one class, so
    one stays; a class whose rows all lack an id keeps one of them.
    """
    return simhash.one_per_class(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a word inside a benchmark window go.

    NULL and wordless texts stay, and so does every row if benchmark is empty; NULL benchmark texts have no
    window; a word in several windows counts once; repeated rows stay or go together.
    """
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays, with its text rewritten.

    NULL and empty texts stay as they are; of valid candidates that overlap the first counts; equal values get
    equal pseudonyms in every row, so repeated rows stay equal.
    """
    return pii.pseudonymise(docs, pii_key(spark))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of every document row.

    NULL and empty texts are one closing id; repeated rows are packed as different documents; of bins that fit
    an item equally well any may take it, so sequence numbers differ between runs, not what is packed.
    """
    return packing.pack_documents(docs, tokenizer_path(spark))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", one_of_each_class),
    ("decontamination", decontaminated),
    ("pii", pseudonymised),
    ("packing", packed),
]

# A trained model, a seeded hash, a keyed permutation and a tokenizer: no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage wrote for itself goes when its result is written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch_scope() as made:
            docs, path = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
            made.remove(path)
        if last:
            remove_scratch(last)
        last = path
    return docs
