"""All registered queries of this package."""

from cartsight.llm import (  # noqa: F401  (register)
    bpe,
    chat,
    licences,
    linecrf,
    machine,
    merkle,
    minhash,
    mixing,
    passages,
    ppm,
    simhash,
    trie,
    whitening,
)
from cartsight.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
