import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ringwise.llm import packing
from tests.llm.conftest import odd_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


def truth(texts):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [np.array([*e.ids, 0], "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check(rows, keys, texts):
    ids = truth(texts)
    # equal keys have pieces of several documents: compare all pieces of a key
    want, got = {}, {}
    for k, i in zip(keys, ids, strict=True):
        want.setdefault(k, []).append(i)
    for r in rows:
        got.setdefault(r["doc_id"], []).append(r)
    assert {k: sum(map(len, v)) for k, v in want.items()} == {k: sum(r["length"] for r in v) for k, v in got.items()}
    for k, pieces in got.items():
        bodies = {zlib.crc32(i[r["start"] : r["start"] + r["length"]].tobytes()) for i in want[k] for r in pieces}
        assert all(r["ids_crc32"] in bodies and r["doc_tokens"] in {len(i) for i in want[k]} for r in pieces)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    return sequences


def test_odd_rows(odd):
    rows = packing.digest(packing.pack(odd, PATH)).collect()
    check(rows, [r[0] for r in odd_rows()], [r[1] for r in odd_rows()])


def test_documents_are_packed_tightly(small):
    df, docs = small
    rows = packing.digest(packing.pack(df, PATH)).collect()
    sequences = check(rows, [d[0] for d in docs], [d[1] for d in docs])
    tokens = sum(r["length"] for r in rows)
    assert len(sequences) == -(-tokens // 1024)


def test_pieces_hold_the_ids(small):
    df, docs = small
    want = dict(zip((d[0] for d in docs), truth([d[1] for d in docs]), strict=True))
    for r in packing.pack(df, PATH, group_tokens=20_000).collect():
        assert bytes(r["ids"]) == want[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()


def test_encoder_equals_the_tokenizer(spark, small):
    r = random.Random(1)
    parts = ["a", "B", " ", "  ", "\n", "'s", "'ll", "1", "é", "!", "　", "\t", "<|endoftext|>", "日", "\x1c", "\x85", "\xa0"]
    texts = ["", " ", "\n", " a", "a ", "a\n b", "a \nb", *("".join(r.choice(parts) for _ in range(r.randint(1, 25))) for _ in range(3_000))]
    texts += ["".join(chr(r.randrange(0x250)) for _ in range(60)) for _ in range(3_000)]
    texts += [x + chr(c) + y + chr(c) for c in range(0x250) for x in "a1 !" for y in ("b", "2", " ", "")]
    texts += [d[1] for d in small[1]]
    got = packing.Encoder(PATH).encode(texts)
    assert [np.frombuffer(b, np.uint16).tolist() for b in got] == [t[:-1].tolist() for t in truth(texts)]


@pytest.mark.parametrize("seed", range(5))
def test_assignment_is_whole_and_balanced(seed):
    r = random.Random(seed)
    lengths = [r.choice([1, 1, 5, 40, 200, 700, 1024, 1025, 5_000]) for _ in range(400)]
    pieces = packing.assign(lengths, 1024, 1.0, 1 / 1024)
    filled, seen = {}, {}
    for d, start, n, s, offset in pieces:
        assert offset == filled.get(s, 0) and n > 0
        filled[s] = offset + n
        seen.setdefault(d, []).append((start, n))
    for d, n in enumerate(lengths):
        at = 0
        for start, k in sorted(seen[d]):
            assert start == at
            at += k
        assert at == n
    assert max(filled.values()) <= 1024 and len(filled) == -(-sum(lengths) // 1024)


def test_empty(none):
    assert packing.pack(none, PATH).collect() == []
