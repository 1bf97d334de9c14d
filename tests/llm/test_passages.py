"""Passages end where the long pattern ends them, and window sizes are kept without copying."""

from __future__ import annotations

import pickle
import random

import numpy as np
import pyarrow as pa

from segloom.llm import language
from segloom.llm.language import Languages, passages


def _slow(text):
    out, at = [], 0
    for cut in [*language._SENTENCE.finditer(text), None]:
        end = cut.start() if cut else len(text)
        n = len(text[at:end].split())
        if n:
            out.append((at, end, text[at:end], n))
        at = cut.end() if cut else end
    return out


def test_passages_end_as_by_the_long_pattern():
    random.seed(3)
    for letters in ("ab .!\n \t;…", "ab .\n—/|  ", "a.\n\u00a0\u2028\r "):
        for _ in range(4000):
            text = "".join(random.choices(letters, k=random.randint(0, 25)))
            assert passages(text) == _slow(text), repr(text)


def test_common_texts_are_spared_the_long_pattern(monkeypatch):
    monkeypatch.setattr(language, "_SENTENCE", None)
    assert [p[2] for p in passages("one two. three\nfour; five")] == ["one two.", "three", "four;", "five"]


def test_known_sizes():
    """Sizes met are those of the texts; the table isn't copied with each batch."""
    languages = Languages(["en", "fr"], [b"the cat sat on the mat and went", b"le chat est sur la table et dort"])
    for at in range(0, 600, 10):
        texts = [f"the chat {i % 450} é" for i in range(at, at + 10)]
        got = languages.known_sizes(texts, bound=500)
        assert np.array_equal(got, languages.sizes([t.encode() for t in texts]))
    assert len(languages.known) == 450 and len(languages.table) < 2000
    before = languages.table
    languages.known_sizes(["another text"])
    assert languages.table is before


def _slow_rows(texts, languages):
    """(text, language, confidence, words, mixed) by a loop over the passages."""
    clear, rows = language.classify(texts, languages)
    by, widest, out = {}, [0.0] * len(texts), []
    for i, _, _, _, _, n, lang, margin, gain, fresh, _ in rows:
        widest[i] = max(widest[i], margin)
        if margin >= language.REJECT:
            held = by.setdefault(i, {}).setdefault(lang, [0, 0.0, False])
            held[0] += fresh
            held[1] += fresh * margin
            held[2] |= n >= language.LEAST_WORDS and margin >= language.SECOND and gain >= language._GAIN
    for i, text in enumerate(clear):
        found = language._CONTENT.findall(text)
        words, held = len(found) - sum(w in language._SILENT for w in found), by.get(i)
        if not held:
            out.append((i, None, widest[i], words, False))
            continue
        ranked = sorted(held, key=lambda k: (-held[k][0], k))
        further = [k for k in ranked[1:] if held[k][2]]
        out += [(i, languages.codes[k], held[k][1] / held[k][0], words, bool(further)) for k in [ranked[0], *further]]
    return out


EN, FR, DE = "the cat sat on the old mat and went home with the other cat", "le chat est sur la vieille table et dort avec un autre chat", "die katze liegt auf dem alten tisch und schläft mit der anderen katze"


def test_records_as_by_a_loop_and_passages_once(monkeypatch):
    """The records' rows are those of a loop; a passage that was met isn't compressed again, in another batch or task of the run."""
    languages = Languages(["de", "en", "fr"], [DE.encode(), EN.encode(), FR.encode()])
    random.seed(4)
    words = f"{EN} {FR} {DE} um, uh “um, ... — - er... hum (x) _y".split()
    parts = [EN, FR, DE, "zz qq", "um, well", "“Um, no” — oui", "\n", "Speaker 1: " + FR]
    texts = [None, "", "  ", *(random.choice([". ", " ", "; ", " — "]).join(random.choices(parts, k=random.randint(1, 5))) for _ in range(400)), *(" ".join(random.choices(words, k=random.randint(1, 45))) for _ in range(400))]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(["en"] * len(texts)), pa.array(texts, pa.string())], names=["id", "label", "text"])
    monkeypatch.setattr(language, "_BATCH", 300)
    rows = [tuple(r.values()) for b in language._record_rows(iter([batch]), languages) for r in b.drop_columns("label").to_pylist()]
    assert len({r[1] for r in rows}) == 4 and any(r[4] for r in rows)
    assert rows == _slow_rows(texts, languages)

    task = pickle.dumps(languages)
    first = pickle.loads(task)
    list(language._record_rows(iter([batch]), first))
    second = pickle.loads(task)
    sent = []
    monkeypatch.setattr(Languages, "sizes", lambda self, found: sent.append(found) or np.zeros((len(found), 3), np.int32))
    list(language._record_rows(iter([batch]), second))
    assert not any(sent)
    other = pickle.loads(pickle.dumps(Languages(["de", "en", "fr"], [DE.encode(), EN.encode(), FR.encode()])))
    assert not other.known and not other.wholes.known  # sizes of another run aren't used
