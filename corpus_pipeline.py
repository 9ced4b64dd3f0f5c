"""From raw documents to token ids: toxic texts out, one of each near-duplicate group, personal
data masked, sources mixed to target weights, texts encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the
columns of the documents.
"""

from firnline.llm import minhash, mixing, personal, sentencepiece_scan, toxicity
from firnline.llm.common import cut, table

NEAR_PERCENT = 80


def drop_toxic(spark, docs, sf_dir):
    """Without the documents that the toxicity classifier rejects."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates (five words, similarity 0.8 or more) stays."""
    return minhash.keep_one(docs, percent=NEAR_PERCENT)


def mask_personal_data(spark, docs, sf_dir):
    """Personal data replaced by its kind."""
    return personal.mask(docs)


def mix_sources(spark, docs, sf_dir):
    """Documents as often, or in such part, as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark, docs, sf_dir):
    """Token ids of every document."""
    keep = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    return sentencepiece_scan.encode(docs, keep=keep)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("weak_supervision_pii", mask_personal_data),
    ("sainte_lague_mix", mix_sources),
    ("sentencepiece_scan", encode),
]

ORACLE_SQL = None  # learned weights and hashes are not for SQL; tests hold the stages against brute force


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
