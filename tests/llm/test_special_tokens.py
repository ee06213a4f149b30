"""The token files' query gives what the library gives by default, special tokens' names in texts included."""

import inspect

import numpy as np
from millrace.llm import queries, token_files
from tokenizers import Tokenizer

BPE = "/opt/tokenizers/byte_bpe_50k.json"
END = "<|endoftext|>"
TEXTS = [f"a {END} b", END, f"{END}{END}", f"x{END}y z", f"end.{END}\nnext line", f"a {END}. b", f"a {END}", f"{END} a", f" {END}  b", f"<{END}>", "<|endoftext", "plain words, and marks!", f"a\n{END}\nb", f"été {END}é", f"tab\t{END}", ""]


def test_special_tokens_named_in_texts():
    plain, encode = Tokenizer.from_file(BPE), token_files.tokenizer_encode(BPE, special=True)
    for text in TEXTS:
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text
    assert np.frombuffer(encode(TEXTS[0].encode()), "<u4").tolist() == [64, 220, 50256, 275]


def test_the_query_uses_the_default():
    assert "special=True" in inspect.getsource(queries.op10_token_files)
