"""What decides in a shard, and hashes that collide."""

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import _repeats, phrases, suffix


def contexts(texts, docs):
    data = [t.encode() for t in texts]
    column = lambda v, kind: np.array(v, kind)
    return _repeats.Contexts(
        column([1] * len(texts), np.uint64), column(docs, np.int64), column(docs, np.int64), column([0] * len(texts), np.int32), column([0] * len(texts), np.int32),
        column([len(t.split()) for t in texts], np.int32), column([len(d) for d in data], np.int32), np.frombuffer(b"".join(data), np.uint8),
    )


class Empty:
    """An automaton that forgets its words."""

    def add_word(self, word, value):
        return True

    def make_automaton(self):
        pass

    def iter(self, *where):
        return []


SAID = " ".join(f"w{i}" for i in range(25))


def test_the_automaton_decides(monkeypatch):
    c = contexts([SAID, "other " + SAID], [4, 9])
    assert phrases.solve(c, phrases.PLAN).tolist() == [False] * 6 + [False] + [True] * 6
    monkeypatch.setattr(phrases.ahocorasick, "Automaton", Empty)
    assert not phrases.solve(c, phrases.PLAN).any()


@pytest.mark.parametrize("symbols", [phrases.SYMBOLS, 7])
def test_windows_are_compared_by_words(monkeypatch, symbols):
    """With hashes that all collide, and with symbols of two characters, only equal words count."""
    monkeypatch.setattr(phrases, "SYMBOLS", symbols)
    texts = [SAID, SAID.replace("w24", "v24"), " ".join(f"u{i}" for i in range(30)), SAID + " " + SAID]
    want = [False] * 6 + [True] * 5 + [False] + [False] * 11 + [True] * 6 + [False] * 19 + [True] * 6
    assert phrases.solve(contexts(texts, [1, 2, 3, 4]), phrases.PLAN).tolist() == want
    proper = phrases.B.span_hash
    monkeypatch.setattr(phrases.B, "span_hash", lambda p, a, b: proper(p, a, b) % np.uint64(3))
    assert phrases.solve(contexts(texts, [1, 2, 3, 4]), phrases.PLAN).tolist() == want


@pytest.mark.parametrize("module", [suffix, phrases])
def test_a_task_settles_only_what_is_equal(monkeypatch, module):
    plan = module.PLAN
    texts = [" ".join(f"w{(7 * i + k * (i > 30)) % 90}" for i in range(60)) for k in (0, 0, 1, 2)] + [SAID * 3]
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    codes = []
    for d in data:
        items = _repeats.items_of(d, np.array([0, len(d)]), plan.unit)
        codes.append(_repeats.anchors(items.value, items.first, plan)[1].tobytes())
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4, 5]), pa.array([11, 12, 13, 14, 15]), pa.array(texts), pa.array(codes)], names=["id", "tag", "text", "codes"])

    def settled():
        out = set()
        for rows in _repeats._cutter(plan, 3, np.zeros(0, np.uint64))([batch]):
            for r in rows.to_pylist():
                if r["kind"] == 1:
                    out |= set(zip(*(np.frombuffer(r[c], k).tolist() for c, k in (("doc", np.int64), ("who", np.int64), ("lo", np.int32), ("items", np.int32)))))
        return out

    right = settled()
    assert {(doc, who) for doc, who, _, _ in right} >= {(2, 12), (3, 13)}
    proper = _repeats.B.span_hash
    monkeypatch.setattr(_repeats.B, "span_hash", lambda p, a, b: proper(p, a, b) % np.uint64(5) if len(np.atleast_1d(a)) < 400 else proper(p, a, b))
    assert settled() <= right
