"""Line dedup, personal data and encoding against plain computations."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docloom.llm.bpe import WordBpe, decode_bpe, encode_bpe
from docloom.llm.line_dedup import SPAN, dedup_lines
from docloom.llm.pii import BASE, find_pii, mask_pii, running_sums
from docloom.llm.words import segments
from tests.llm.helpers import SCHEMA, edge_rows, frame

LOWER = {c: c + 32 for c in range(65, 91)}


def plain_line_dedup(rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    order = lambda i: (i is None, i)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [len(h := holders.get(key(line), ())) >= 2 and min(h, key=order) != i for line in lines]
        out.append((i, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)))
    return sorted(out, key=repr)


def test_line_dedup(spark):
    rows = edge_rows()
    found = dedup_lines(frame(spark, rows))
    assert found.columns == [*SCHEMA.names, "_n_lines", "_n_dropped"]
    got = [(r.doc_id, r.text, r._n_lines, r._n_dropped) for r in found.collect()]
    assert sorted(got, key=repr) == plain_line_dedup(rows)
    assert max(r[2] for r in got) > 2 * SPAN and sum(r[3] for r in got) > 1000


def test_line_dedup_threshold_and_empty(spark):
    rows = [(1, "abc\nshared by two"), (2, "shared by two\nin all three"), (3, "in all three"), (4, "in all three")]
    three = {r.doc_id: r.text for r in dedup_lines(frame(spark, rows), min_docs=3).collect()}
    assert three == {1: "abc\nshared by two", 2: "shared by two\nin all three", 3: "", 4: ""}
    assert dedup_lines(frame(spark, [])).count() == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def confirmed(kind, found):
    digits = [int(c) for c in found if c.isdigit()]
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "card":
        doubled = [d * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return True


def plain_pii(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PLAIN.items() for m in re.finditer(pattern, text or "") if confirmed(kind, m.group())
    ]


PII_TEXTS = [
    "a.b@c.de", "a@b.c_d@e.f", "x@y..z a@b-c.d.", "@@a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 000255.1.2.3 1.2.3", "1.2.3.x1.2.3.4",
    "4041894974608795 4041-8949 7460-8795, 4041894974608796", "1234 5678", "+1 (415) 555-0100. +12 +1234567) 8", "+1+123456789",
    "é✓ 😀 a@b.co ✓ 10.0.0.1", "9" * 40, "mail a@b.c, " * 700, "1.1.1.1 " * 600 + "x", "a" * 20_000, "", None,
]


def test_pii_base_spans(spark):
    names = [kind.name for kind in BASE]
    rows = list(enumerate(PII_TEXTS)) + edge_rows()
    got = find_pii(frame(spark, rows)).select("text", "_pii", "lang").collect()
    for row in got:
        assert [(s.kind, s.start, s.end) for s in row["_pii"] if s.kind in names] == plain_pii(row.text), row.text[:60]
        assert row.lang == "x"
    assert len(got) == len(rows) and find_pii(frame(spark, [])).count() == 0


def test_pii_added_kinds(spark):
    texts = [
        "pay to DE89 3704 0044 0532 0130 00 now", "not DE89 3704 0044 0532 0130 01", "ssn 123-45-6789", "part 123-45-6789",
        "visa 378282246310005", "serial 378282246310005",
    ]
    got = find_pii(frame(spark, enumerate(texts))).select("doc_id", "_pii").collect()
    kinds = {r.doc_id: [s.kind for s in r["_pii"] if s.kind not in PLAIN] for r in got}
    assert kinds == {0: ["iban"], 1: [], 2: ["ssn"], 3: [], 4: ["short_card"], 5: []}


def test_pii_mask(spark):
    rows = [(1, "write a@b.co or 10.0.0.1, card 4041894974608795!"), (2, None), (3, "nothing 999.1.1.1"), (3, "nothing 999.1.1.1")]
    got = [r.text for r in mask_pii(frame(spark, rows)).orderBy("doc_id").collect()]
    assert got == ["write <EMAIL> or <IP>, card <CARD>!", "", "nothing 999.1.1.1", "nothing 999.1.1.1"]


def test_running_sums(spark):
    for n in (1, 256, 257, 1000):
        row = spark.range(1).select(running_sums(F.sequence(F.lit(1).cast("long"), F.lit(n).cast("long"))).alias("s")).first()
        assert row.s == np.cumsum(np.arange(1, n + 1)).tolist()


BPE_TEXTS = [
    "don't I'll 'start ''s l'eau 'll 12½", "<|endoftext|>it's <|startoftext|>", "İstanbul ΣΑΣ Å", "ab" * 900, "x" * 5000,
    "tab\tand\x1cseparators\x85here\xa0", "😀😀 日本語", "'", "'s", "  ", "A1B2'RE", None, "",
]


@pytest.fixture(scope="module")
def word_path():
    return public_tokenizers.path("word_bpe_49k.json")


def test_bpe_matches_library_and_decodes(spark, word_path):
    library = Tokenizer.from_file(word_path)
    rows = list(enumerate(BPE_TEXTS, start=1000)) + edge_rows()
    documents = frame(spark, rows).drop("ids")
    coded = encode_bpe(documents, word_path, decode=True)
    assert coded.columns == [c for c in SCHEMA.names if c not in ("text", "ids")] + ["ids", "decoded"]
    texts = {}
    for i, text in rows:
        texts.setdefault(i, []).append(text or "")
    for row in coded.collect():
        wanted = [library.encode(t, add_special_tokens=False).ids for t in texts[row.doc_id]]
        assert row.ids in wanted
        assert row.decoded == library.decode(row.ids, skip_special_tokens=False)
    again = decode_bpe(coded.drop("decoded"), word_path)
    assert again.select("doc_id", "decoded").exceptAll(coded.select("doc_id", "decoded")).isEmpty()
    assert encode_bpe(frame(spark, []).drop("ids"), word_path).count() == 0


def test_bpe_random_texts(word_path):
    rng = np.random.default_rng(2)
    model, library = WordBpe(word_path), Tokenizer.from_file(word_path)
    alphabet = list("ab's'tl rvEd  \n\t12\xa0é!'\x85\x1cÄß-–")
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 60))) for _ in range(1500)]
    for text, ids in zip(texts, model.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    parts = rng.integers(0, 49_000, 700).tolist()
    assert model._merge_long([*parts]) == _merge_plainly(model, parts)


def test_parts_of_long_texts_give_the_same_ids(word_path):
    """Texts are cut where words end anyway, for both kinds of vocabulary."""
    text = " ".join(t for _, t in edge_rows() if t) + " don't  stop 'll 12 34 l'eau" * 20
    parts = list(segments(text, 200))
    assert len(parts) > 50 and "".join(parts) == text
    for path in (word_path, public_tokenizers.path("byte_bpe_50k.json")):
        library = Tokenizer.from_file(path)
        whole = library.encode(text, add_special_tokens=False).ids
        assert [i for part in parts for i in library.encode(part, add_special_tokens=False).ids] == whole


def _merge_plainly(model, parts):
    parts = [*parts]
    while True:
        ranks = [model.ranks.get(a * model.base + b, 2**31) for a, b in zip(parts, parts[1:])]
        if not ranks or min(ranks) == 2**31:
            return parts
        i = ranks.index(min(ranks))
        parts[i : i + 2] = [model.made[ranks[i]]]


def test_hashes(spark):
    """The query's digests are what hashlib gives."""
    from docloom.llm.queries import op3_line_dedup

    row = op3_line_dedup(spark, "/root/testdata/sf0.001").filter("n_dropped = 0").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter(F.col("doc_id") == row.doc_id).first().text
    assert row.kept_sha256 == hashlib.sha256(text.encode()).hexdigest()
