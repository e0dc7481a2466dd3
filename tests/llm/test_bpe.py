import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabwright.llm import bpe, queries

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tool = Tokenizer.from_file(FILE)
    tool.no_padding()
    tool.no_truncation()
    return tool


@pytest.fixture(scope="module")
def own():
    return bpe.Tokenizer(FILE)


def digest(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    packed = np.array(ids, "<u4").tobytes()
    spelled = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(spelled.encode()).hexdigest()


def agree(own, library, texts):
    for text, known in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == known.ids, text
        assert own.decode(own.encode(text)) == library.decode(known.ids, skip_special_tokens=False)


def test_whole_table(spark, sf, library):
    want = {r.doc_id: digest(library, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op12_bpe(spark, sf).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(want)


def test_corner_cases(spark, library):
    texts = [None, "", " \n ", "x" * 50000, "ab " * 40000, "a<|endoftext|>B<|startoftext|>", "<|EndOfText|>", "same", "same", "é ΑΣ İ 'S"]
    rows = [(i if i != 7 else None, t, "kept", "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, n_tokens string").repartition(3)
    coded = bpe.decode(bpe.encode(df, FILE), FILE)
    assert coded.columns == ["doc_id", "text", "row", "ids", "n_tokens", "decoded"]
    got = sorted((str(r.text), r.n_tokens, hashlib.sha256(r.ids).hexdigest(), hashlib.sha256(r.decoded.encode()).hexdigest(), r.row) for r in coded.collect())
    assert got == sorted((str(t), *digest(library, t), "kept") for t in texts)
    assert bpe.encode(df.limit(0), FILE).collect() == []
    assert bpe.decode(spark.createDataFrame([(None,)], "ids binary"), FILE).first().decoded == ""


def test_random_pieces(own, library):
    rng = random.Random(5)
    for signs in ("aab", "etaoinshr", "abc!<|>'sé  ΣİßÅ\n"):
        agree(own, library, ["".join(rng.choice(signs) for _ in range(rng.randint(1, 40))) for _ in range(2000)])


def test_every_sign(own, library):
    agree(own, library, [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 0)])


def merged(symbols, ranks):
    """The merges applied one rule at a time, leftmost first."""
    parts = list(symbols)
    for rule in ranks:
        i = 0
        while i + 1 < len(parts):
            if (parts[i], parts[i + 1]) == rule:
                parts[i : i + 2] = ["".join(rule)]
            i += 1
    return parts


def test_gadgets_on_small_vocabularies():
    """All strings of up to seven letters under random lists of merges, against the merges themselves."""
    rng = random.Random(3)
    signs = bpe.byte_signs()
    for _ in range(6):
        tokens, merges = ["a", "b", "c"], []
        while len(merges) < 9:
            rule = (rng.choice(tokens), rng.choice(tokens))
            if "".join(rule) not in tokens and len("".join(rule)) < 6:
                merges.append(rule)
                tokens.append("".join(rule))
        vocab = {s: i for i, s in enumerate([*signs, *(s + "$" for s in signs), *(t for t in tokens if len(t) > 1)])}
        tool = bpe.Automaton(vocab, merges, "$")
        todo = [""]
        for word in todo:
            if word:
                expect = merged([*word, "z$"], merges)
                assert [tool.labels[i] for i in tool.piece((word + "z").encode())] == expect
            if len(word) < 6:
                todo += [word + x for x in "abc"]


def test_broken_lists_are_refused():
    signs = bpe.byte_signs()
    vocab = {s: i for i, s in enumerate([*signs, *(s + "$" for s in signs), "ab", "abc"])}
    with pytest.raises(ValueError):
        bpe.Automaton(vocab, [("ab", "c")], "$")
