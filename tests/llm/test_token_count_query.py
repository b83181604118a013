"""The three batches of the token count query against the tokenizer itself."""

import re
from collections import Counter

from tokenizers import Tokenizer

from kinfold.llm.queries import op1_token_counts, tokenizer_file
from tests.llm.conftest import SF


def test_totals_of_the_three_batches(spark):
    encode = Tokenizer.from_file(tokenizer_file()).encode
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    documents, tokens = Counter(), Counter()
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        if quality.get(d.doc_id) == 0:
            continue
        text = d.text or ""
        if quality.get(d.doc_id) == 1:
            text = re.sub(r"[ \t\n\x0b\f\r]+", " ", text)
        documents[d.source, d.lang] += 1
        tokens[d.source, d.lang] += len(encode(text, add_special_tokens=False).ids)
    got = {(r.source, r.lang): (r.documents, r.tokens) for r in op1_token_counts(spark, SF).collect()}
    assert got == {k: (documents[k], tokens[k]) for k in documents}
