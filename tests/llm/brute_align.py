"""Alignment of two tokenizers by plain loops over bytes."""

import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer


def _visible():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {}, 0
    for x in range(256):
        if x in shown:
            table[chr(x)] = x
        else:
            table[chr(256 + extra)] = x
            extra += 1
    return table


def brute_alignment(docs):
    """docs: (id, text) -> sorted rows, and for each document its links (a_at, b_at, a_id, b_id, bytes) and groups."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte = _visible()
    parts = []
    for key, text in docs:
        if not text:
            parts.append((key, [], [], [], []))
            continue
        x = a.encode(" " + text, add_special_tokens=False).ids
        y = b.encode(text)
        bx = [bytes(byte[c] for c in a.id_to_token(i)) for i in x]
        by = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not b"".join(bx) == b"".join(by) == (" " + text).encode():
            parts.append((key, [], [], [], []))
            continue
        owner = [[], []]
        for side, tokens in enumerate((bx, by)):
            for i, t in enumerate(tokens):
                owner[side] += [i] * len(t)
        links = Counter(zip(*owner))
        ends = [set(), set()]
        for side, tokens in enumerate((bx, by)):
            at = 0
            for t in tokens:
                at += len(t)
                ends[side].add(at)
        groups, i, j, at_a, at_b = [], 0, 0, 0, 0
        for cut in sorted(ends[0] & ends[1]):
            left, right = [], []
            while at_a < cut:
                left.append(i)
                at_a += len(bx[i])
                i += 1
            while at_b < cut:
                right.append(j)
                at_b += len(by[j])
                j += 1
            groups.append((left, right))
        parts.append((key, x, y, [(i, j, x[i], y[j], n) for (i, j), n in sorted(links.items())], groups))
    counts = Counter(p for part in parts for p in {(r[2], r[3]) for r in part[3]})
    top = {}
    for (i, _), n in counts.items():
        top[i] = max(top.get(i, 0), n)
    rows = []
    for key, x, y, links, groups in parts:
        said = ";".join(",".join(str(x[i]) for i in left) + "|" + ",".join(str(y[j]) for j in right) for left, right in groups)
        best = sum(counts[r[2], r[3]] == top[r[2]] for r in links)
        total = sum(counts[r[2], r[3]] for r in links)
        shared = sum(len(left) * len(right) for left, right in groups)
        rows.append((key, len(x), len(y), len(groups), len(links), shared, best, total, hashlib.sha256(said.encode()).hexdigest() if x else ""))
    return rows, parts
