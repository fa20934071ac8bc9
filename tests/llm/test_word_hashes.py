"""Long words that differ in every letter must not be taken for each other."""

import numpy as np
from tokenizers import Tokenizer

from docloom.llm.bpe import encode_bpe
from docloom.llm.ngram_join import ngram_join
from docloom.llm.packing import ByteBpe, pack
from docloom.llm.queries import vocabulary
from docloom.llm.words import Memory, run_hashes
from tests.llm.helpers import frame

MORSE = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
OTHER = MORSE.translate(str.maketrans("ab", "ba"))


def test_hashes_differ():
    for size in (2, 31, 32, 33, 64, 256, 1024, 2048, 4096):
        data = np.frombuffer((MORSE[:size] + OTHER[:size]).encode(), dtype=np.uint8)
        one, other = run_hashes(data, np.array([0, size]), np.array([size, 2 * size]))
        assert one != other
        assert run_hashes(data[size:], np.array([0]), np.array([size]))[0] == other


def test_ids_are_those_of_the_library(spark):
    text = f"{MORSE} and {OTHER} {MORSE[:1024]} {OTHER[:1024]}"
    rows = [(1, text), (2, OTHER), (3, MORSE)]
    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = {r.doc_id: r.ids for r in encode_bpe(frame(spark, rows).drop("ids"), path).collect()}
    assert got == {i: library.encode(t, add_special_tokens=False).ids for i, t in rows}
    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    lengths = {}
    for r in pack(frame(spark, rows).select("doc_id", "text"), path, capacity=1024, end_id=2).collect():
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}


def test_documents_without_a_common_word_are_not_linked(spark):
    docs = frame(spark, [(1, MORSE), (2, OTHER), (3, f"{MORSE} x y z"), (4, f"{OTHER} x y z"), (5, OTHER)])
    got = {r.doc_id: r.component_id for r in ngram_join(docs.select("doc_id", "text"), n=3, percent=90).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 2}


def test_new_words_are_encoded_in_one_call():
    model = ByteBpe(vocabulary("byte_bpe_50k.json"))
    library, calls = model.library, []

    class Counted:
        def encode(self, *args, **kinds):
            calls.append("one")
            return library.encode(*args, **kinds)

        def encode_batch_fast(self, words, **kinds):
            calls.append("all")
            return library.encode_batch_fast(words, **kinds)

    model.library = Counted()
    texts = [" ".join(f"caf\xe9{i}x{k}\n it's" for k in range(40)) for i in range(30)] + ["", " ", "\xa0"]
    for _ in range(2):
        assert [x.tolist() for x in model.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert calls == ["all"]


def test_a_memory_gives_each_word_its_own_value():
    made = []

    def make_all(words):
        made.extend(words)
        return [w * 2 for w in words]

    for memory in (Memory(lambda w: w * 2, size=5), Memory(lambda w: w * 2, size=5, make_all=make_all)):
        for i in range(20):
            words = [f"w{k}" for k in range(i, i + 4)]
            assert memory.all(words) == [w * 2 for w in words] and memory["w3"] == "w3w3"
            assert len(memory) + len(memory.older) < 2 * (5 + 4)
    assert made == [f"w{k}" for k in range(23)]
