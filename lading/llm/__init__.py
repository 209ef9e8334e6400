"""Operators that prepare training text: filters, near copies, mixing, tokens, scores, audits.

Every module holds one operator with a general interface; ``queries`` applies each to its whole
table and ``stages`` strings some of them together. Code that tasks need travels with their
functions, by value: executors do not have to have this package installed.
"""

from pyspark import cloudpickle

from ..jobs import store
from . import (
    bpe, chunks, clusters, divergence, hyperminhash, kneser_ney, mixture, neighbours, quality, rans,
    token_files, words,
)

for _module in (
    bpe, chunks, clusters, divergence, hyperminhash, kneser_ney, mixture, neighbours, quality, rans,
    store, token_files, words,
):
    cloudpickle.register_pickle_by_value(_module)
