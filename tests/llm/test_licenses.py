import numpy as np
import pytest
from .plain import folded, prose

from stratum.llm import licenses as L


LONG, TWICE = 10**7 + 3, 10**7 + 4


def shingles(text):
    w = folded(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def best_share(text, template):
    """Largest share of the template's shingles in any stretch of the text."""
    w, own = folded(text), shingles(template)
    n = L.stretch(len(folded(template)))
    return max((len({tuple(w[i:i + 5]) for i in range(s, min(s + n, len(w) - 4))} & own) / len(own)
                for s in range(max(1, len(w) - 4))), default=0.0)


def cases():
    rng = np.random.default_rng(12)
    rows = []
    for k, (name, text) in enumerate(sorted(L.LICENSES.items())):
        for pad in range(5):  # every place against the grid of windows
            rows.append((1000 * k + pad, f"{prose(rng, 10 + pad)} {text} {prose(rng, 20)}", "en", "s"))
        w = text.split()
        if len(w) > 60:  # a few words edited
            for at in (7, 40):
                w[at] = "changed"
            rows.append((1000 * k + 100, f"{prose(rng, 33)} {' '.join(w)}", "en", "s"))
            half = text.split()[: len(w) // 2]
            rows.append((1000 * k + 200, " ".join(half), "en", "s"))
        rows.append((1000 * k + 300, text.upper().replace(" ", " -- "), "en", "s"))
    clean = [(10**6 + i, prose(rng, int(n)), "en", "s") for i, n in enumerate(rng.integers(0, 400, 100))]
    awkward = [(10**7, None, None, None), (10**7 + 1, "", "en", "s"), (10**7 + 2, "the MIT License", "en", "s"), (None, L.LICENSES["MIT-line"], "en", "s"),
               (LONG, prose(rng, 30_000) + " " + L.LICENSES["ISC"], "en", "s"), (TWICE, L.LICENSES["MIT-line"] + " x " + L.LICENSES["MIT-line"], "en", "s")]
    return rows, clean, awkward + awkward[-2:-1]


@pytest.mark.parametrize("block_words", [L.BLOCK_WORDS, 60])
def test_scan_equals_brute_force(documents, block_words):
    rows, clean, awkward = cases()
    every = [*rows, *clean, *awkward]
    got = L.scan(documents(every), block_words=block_words).collect()
    found = {(r.doc_id, r.license) for r in got}
    want = {(i, n) for i, t, *_ in every for n, text in L.LICENSES.items() if len(t or "") < 10**5 and best_share(t, text) >= 0.8}
    assert found - {(LONG, "ISC")} == want and (LONG, "ISC") in found
    assert sum(r.doc_id == LONG for r in got) == 2  # a repeated row
    assert sum(r.doc_id == TWICE for r in got) == 2  # two places
    where = next(r for r in got if r.license == "MIT-line" and r.doc_id in {i for i, t, *_ in rows if L.LICENSES["MIT-line"] in t})
    text = folded(dict((i, t) for i, t, *_ in every)[where.doc_id])
    assert text[where.from_word:where.to_word] == folded(L.LICENSES["MIT-line"])


def test_empty_tables(documents):
    docs = documents([(1, L.LICENSES["MIT"], "en", "s")])
    assert L.scan(docs.where("false")).count() == 0
    assert L.scan(docs, {}).count() == 0 and L.scan(docs, {"tiny": "two words"}).count() == 0


def test_bands_meet_the_bound():
    n = L.bands_for(0.25, 1e-5)
    assert 0.75 ** n <= 1e-5 < 0.75 ** (n - 1)


def plain_best(found):
    """Finds of one text that no better find of another template overlaps, pair by pair."""
    size = {n: len(shingles(t)) for n, t in L.LICENSES.items()}

    def worth(m):
        return round(m.containment * size[m.license]), m.containment

    def beaten(m):
        return any(o.license != m.license and o.from_word < m.to_word and m.from_word < o.to_word
                   and (worth(o) > worth(m) or (worth(o) == worth(m) and o.license < m.license)) for o in found)

    return [m for m in found if not beaten(m)]


@pytest.mark.parametrize("block_words", [L.BLOCK_WORDS, 600])
def test_templates_compete_for_a_place(documents, block_words):
    rows, clean, awkward = cases()
    rows = [r for r in rows if r[0] % 1000 in (0, 3, 100, 200, 300)]
    several = [(2 * 10**7, " and also ".join(L.LICENSES[n] for n in ("GPL-2.0-line", "CC-BY-NC-4.0", "BSD-3-Clause", "Apache-2.0-header")), "en", "s")]
    docs = documents([*rows, *clean[:5], *awkward, *several])
    every = L.scan(docs, block_words=block_words).collect()
    got = L.scan(docs, block_words=block_words, best=True).collect()
    groups = {}
    for m in every:
        groups.setdefault(m.doc_id, []).append(m)
    want = [m for found in groups.values() for m in plain_best(found)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {m.license for m in got if m.doc_id == 2 * 10**7} == {"GPL-2.0-line", "CC-BY-NC-4.0", "BSD-3-Clause", "Apache-2.0-header"}


def test_each_template_finds_itself_and_no_sibling(documents):
    names = sorted(L.LICENSES)
    rng = np.random.default_rng(5)
    rows = [(i, f"{prose(rng, 12)} {L.LICENSES[n]} {prose(rng, 9)}", "en", "s") for i, n in enumerate(names)]
    got = L.scan(documents(rows), best=True).collect()
    assert sorted((r.doc_id, r.license) for r in got) == list(enumerate(names))
    assert all(r.containment == 1.0 for r in got)
    assert L.scan(documents(rows).where("false"), best=True).count() == 0
    assert L.scan(documents(rows).where("false"), best=True, block_words=600).count() == 0
