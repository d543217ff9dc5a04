"""Licence families that share clauses, and the classifier's chances against a plain computation."""

import numpy as np
import pyarrow as pa
import pytest
from made_up import words

from corpusflow.llm import licenses

T = licenses.TEMPLATES
CLAUSES = T["BSD-3-Clause"][4]
DISCLAIMER = T["BSD-3-Clause"][5]
ZLIB = "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.\n\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software."
GPL_2 = T["GPL-2.0"][3] + "\n\n" + T["GPL-2.0"][4]
APACHE = T["Apache-2.0"][4].replace("Apache", "same")


@pytest.fixture(scope="module")
def model():
    return licenses.train([words(i, 12) for i in range(200)])


def families(model, text):
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1]), "text": pa.array([text])})
    (block,) = licenses.blocks([batch], 1 << 30)
    found = licenses.scan_block(block, model)
    next(found)
    return sorted({f for _, _, f, _, c in licenses._open_only(list(found)) if c >= licenses.CONTAINED})


@pytest.mark.parametrize(
    "text, want",
    [
        (f"  GNU LESSER GENERAL PUBLIC LICENSE\n      Version 2.1, February 1999\n\n{words(1, 50)}\n\n{GPL_2}\n\n{T['LGPL'][3]}", ["LGPL"]),
        (f"GNU LIBRARY GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n\n{GPL_2}", ["LGPL"]),
        (f"GNU GENERAL PUBLIC LICENSE\nVersion 1, February 1989\n\n{words(1, 50)}\n\n{T['GPL-2.0'][1]}", ["GPL-1.0"]),
        (f"GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n\n{T['LGPL'][1]}\n\n{GPL_2}", ["GPL-2.0"]),
        (f"MOZILLA PUBLIC LICENSE\nVersion 1.1\n\n{words(3, 40)}\n\n{T['Apache-2.0'][4]}\n\n{T['Apache-2.0'][1]}", ["MPL-1.1"]),
        (APACHE, []),
        (f"Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/\n\n{words(4, 80)}", ["Apache-2.0"]),
        (f"Creative Commons Legal Code\n\nCC0 1.0 Universal\n\n{words(5, 60)}", ["CC0-1.0"]),
        (f"Copyright 2020 One\n\n{CLAUSES}\n\n{DISCLAIMER}", ["BSD-2-Clause"]),
        (f"Copyright 2020 One\n\n{CLAUSES}\n\n{T['BSD-3-Clause'][2]}\n\n{DISCLAIMER}", ["BSD-3-Clause"]),
        (f"{T['BSD-3-Clause'][1]}\n\n1. Redistributions of source code must retain the above copyright notice.\n\n{ZLIB}\n\n{DISCLAIMER}", ["bzip2-1.0.6"]),
        (f"{T['Zlib'][2]}\n\n{ZLIB}", ["Zlib"]),
        (f"{words(6, 30)}\n\nLicensed under the BSD 3-Clause License.\n\n{words(7, 30)}\n\n{T['LGPL'][3]}\n\n{GPL_2}", ["BSD-3-Clause", "GPL-2.0", "LGPL"]),  # notices, no title
    ],
)
def test_related_families(model, text, want):
    assert families(model, text) == want


def test_chances_by_hand(model):
    """One paragraph at a time: the weights of its word pairs and triples, over the root of its words, through the softmax at the fitted temperature."""
    weights = dict(zip(model.features.tolist(), model.weights.astype(float)))
    for text in (T["MIT"][1], T["ISC"][1], T["GPL-3.0"][0], "Licensed under CC BY 4.0."):
        batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1]), "text": pa.array([text])})
        (block,) = licenses.blocks([batch], 1 << 30)
        s, e, _ = licenses.words(block, licenses.ALNUM)
        h = licenses.span_hashes(block.buf, s, e)
        two, three = licenses.ngrams(h, np.arange(len(h)) < len(h) - 1)
        grams = [g for x in (two, three) for g in x.tolist() if g in weights]
        z = (sum((weights[g] for g in grams), np.zeros(len(licenses.FAMILIES))) / np.sqrt(len(h)) + model.bias) / model.temperature
        want = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        sums = np.zeros((1, len(licenses.FAMILIES)))
        for x in (two, three):
            _, place = model.places(x)
            sums += model.weights[place].sum(axis=0)
        assert model.chances(sums, np.array([len(h)]))[0] == pytest.approx(want, rel=1e-4)
        found = licenses.scan_block(block, model)
        next(found)
        assert max(p for *_, p, _ in found) >= want.max() - 1e-4
