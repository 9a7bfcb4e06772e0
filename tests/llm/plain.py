"""Tables with every awkward case, and a reading of words in plain Python."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def folded(text):
    return re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{x}" for x in rng.integers(0, vocabulary, n))
