"""The operators of this subpackage bound to their tables, as named queries."""

from __future__ import annotations

from . import bpe, decontaminate, htmltext, language, merkle, mixing, multiindex, pii, repeats, simhash, spelling, sql, tokenfile, toxicity
from .common import read


def op1_main_text(spark, sf_dir):
    """Main text of all pages."""
    return htmltext.op1_main_text(spark, read(spark, sf_dir, "pages"))


def op2_toxicity(spark, sf_dir):
    """Toxicity scores of all documents, learned outside the held-out third."""
    return toxicity.op2_toxicity(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_token_files(spark, sf_dir):
    """Token ids of all documents, read back from the files they were written to."""
    return tokenfile.op3_token_files(spark, read(spark, sf_dir, "documents"))


def op4_bpe(spark, sf_dir):
    """Ids and decoded text of all documents."""
    return bpe.op4_bpe(spark, read(spark, sf_dir, "documents"))


def op5_simhash(spark, sf_dir):
    """Fingerprints of all documents, and the components that near ones form."""
    return simhash.op5_simhash(spark, read(spark, sf_dir, "documents"))


def op6_language(spark, sf_dir):
    """Languages of all documents, learned outside the held-out quarter."""
    return language.op6_language(spark, read(spark, sf_dir, "documents"))


def op7_pii(spark, sf_dir):
    """Personal data in all documents."""
    return pii.op7_pii(spark, read(spark, sf_dir, "documents"))


def op8_vectors(spark, sf_dir):
    """Links and components of all vectors."""
    return multiindex.op8_vectors(spark, read(spark, sf_dir, "embeddings"))


def op9_repeats(spark, sf_dir):
    """All documents without the passages that occur elsewhere, too."""
    return repeats.op9_repeats(spark, read(spark, sf_dir, "documents"))


def op10_decontaminate(spark, sf_dir):
    """Test items found in all documents."""
    return decontaminate.op10_decontaminate(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_spelling(spark, sf_dir):
    """Words of all documents with their frequent forms, roots and numbers of near words."""
    return spelling.op11_spelling(spark, read(spark, sf_dir, "documents"))


def op12_mixing(spark, sf_dir):
    """All documents with their source's target and the words taken of them."""
    return mixing.op12_mixing(spark, read(spark, sf_dir, "documents"))


def op13_merkle(spark, sf_dir):
    """All documents as leaves of a Merkle tree by language, with proofs and their check."""
    return merkle.op13_merkle(spark, read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_main_text, op2_toxicity, op3_token_files, op4_bpe, op5_simhash, op6_language, op7_pii, op8_vectors,
                                     op9_repeats, op10_decontaminate, op11_spelling, op12_mixing, op13_merkle)}
ORACLES: dict[str, str] = {"op11_spelling": sql.SPELLING, "op12_mixing": sql.MIXING, "op13_merkle": sql.MERKLE}
