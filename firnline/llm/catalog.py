"""The numbered queries over the given tables; SQL checks where SQL can say the same."""

from . import embedding_pairs, licences, merkle, minhash, mixing, neighbours, pages, personal, quality, repeats, sentencepiece_scan, term_scan, toxicity
from .common import table

QUERIES = {}
ORACLES = {}


def query(name):
    def add(fn):
        QUERIES[name] = fn
        return fn

    return add


@query("op1_html_blocks")
def op1(spark, sf_dir):
    return pages.extract(table(spark, sf_dir, "pages"))


@query("op2_weak_supervision_pii")
def op2(spark, sf_dir):
    return personal.find(table(spark, sf_dir, "documents"))


@query("op3_sainte_lague_mix")
def op3(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


ORACLES["op3_sainte_lague_mix"] = mixing.oracle()


@query("op4_quality_classifier")
def op4(spark, sf_dir):
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_embedding_pairs")
def op5(spark, sf_dir):
    return embedding_pairs.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op6_minhash_hamming")
def op6(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_sentencepiece_scan")
def op7(spark, sf_dir):
    return sentencepiece_scan.encode(table(spark, sf_dir, "documents"))


@query("op8_licence_sentences")
def op8(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents"))


ORACLES["op8_licence_sentences"] = licences.oracle()


@query("op9_navigable_graph")
def op9(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@query("op10_toxicity")
def op10(spark, sf_dir):
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_longest_previous")
def op11(spark, sf_dir):
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


@query("op12_term_scan")
def op12(spark, sf_dir):
    return term_scan.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_term_scan"] = term_scan.oracle()


@query("op13_merkle_manifest")
def op13(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))


ORACLES["op13_merkle_manifest"] = merkle.oracle()
