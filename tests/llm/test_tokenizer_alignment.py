import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from llm_helpers import awkward, empty, frame, prose
from tokenizers import Tokenizer

from lociweave.llm import queries, tokenizer_alignment
from lociweave.llm.tables import read

FILES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def byte_letters():
    """Stated on its own: the bytes that stand for themselves, and letters from 256 on for the others in ascending order."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, extra = {chr(b): b for b in kept}, 256
    for b in range(256):
        if b not in kept:
            out[chr(extra)] = b
            extra += 1
    return out


def brute_force(rows):
    a_lib, b_lib = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    a_lib.encode_special_tokens = True
    letters, counts, docs = byte_letters(), Counter(), []
    for key, text in rows:
        a = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in a_lib.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_lib.id_to_piece(i)]]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            docs.append((key, [], [], [], []))
            continue
        spans = []
        for side in (a_bytes, b_bytes):
            ends = np.cumsum(list(map(len, side)))
            spans.append(list(zip((ends - list(map(len, side))).tolist(), ends.tolist())))
        links, first = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][first][1] <= s:
                first += 1
            j = first
            while j < len(b) and spans[1][j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        shared = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, start = [], 0
        by_end = [defaultdict(list), defaultdict(list)]
        for side, ids in ((0, a), (1, b)):
            at = 0
            for (_, e), i in zip(spans[side], ids):
                by_end[side][shared[at]].append(i)
                at += e == shared[at]
        groups = [(by_end[0][e], by_end[1][e]) for e in shared]
        counts.update(links)
        docs.append((key, a, b, groups, links))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for key, a, b, groups, links in docs:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        n_best, total = sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links)
        out.append((key, len(a), len(b), len(groups), len(links), n_best, total, hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def cases():
    rows = awkward() + [(20 + i, prose(i, 40 + i)) for i in range(12)]
    return rows + [(40, " leading and  double   spaces "), (41, "a ▁ mark"), (42, "<|endoftext|> and <s> and <0x41>"), (43, "\x00 zero"), (44, "naïve ﬁ ① Ａ é"), (45, "的" * 300 + " 。")]


@pytest.mark.parametrize("remembered, held, block", [(8_000_000, 4_000_000, 2_000_000), (50, 10, 97)])
def test_equals_brute_force(spark, monkeypatch, remembered, held, block):
    monkeypatch.setattr(tokenizer_alignment, "REMEMBERED", remembered)
    monkeypatch.setattr(tokenizer_alignment, "HELD", held)
    rows = cases()
    got = tokenizer_alignment.align(frame(spark, rows), *FILES, P.PATTERN, block=block)
    assert order(tuple(r) for r in got.collect()) == order(brute_force(rows))
    assert tokenizer_alignment.align(empty(spark), *FILES, P.PATTERN, block=block).count() == 0


def test_library_takes_over(monkeypatch):
    with open(FILES[0], encoding="utf-8") as file:
        text = file.read()
    side = tokenizer_alignment.ByteLevel(text, P.PATTERN)
    assert side.ranked and not tokenizer_alignment.ByteLevel(text, r"\S+|\s+").ranked
    other = tokenizer_alignment.ByteLevel(text, r"\S+|\s+")
    assert all(side.encode(t) == other.encode(t) for _, t in cases() if t)


def test_groups_are_returned(spark):
    found, _ = tokenizer_alignment.alignments(frame(spark, [(1, "unbelievable words"), (2, None)]), *FILES, P.PATTERN, groups=True)
    rows = {r.doc_id: r for r in found.collect()}
    assert hashlib.sha256(rows[1].groups.encode()).hexdigest() == rows[1].groups_sha256 and rows[2].groups == rows[2].groups_sha256 == ""


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in read(spark, folder, "documents").collect()]
    assert order(tuple(r) for r in queries.op13_tokenizer_alignment(spark, folder).collect()) == order(brute_force(rows))
