"""Constants and a DuckDB comparison shared by the tests of the llm operators."""

import re

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
WORD = r"[^\x20\x09-\x0D]+"
W = re.compile(WORD)
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text, lower=False):
    text = text or ""
    if lower:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return W.findall(text)
