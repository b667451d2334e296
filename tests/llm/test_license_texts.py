"""The licence query on bodies, commented headers and varied punctuation."""

import random

from rubric.llm import licenses, queries


def test_license_query(spark, tmp_path):
    full = licenses.full_templates()
    bodies = {name: max(full[name], key=len) for name in (
        "MIT", "Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "Unlicense", "ISC")}
    rng = random.Random(2)
    filler = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))

    def commented(text, mark):
        words = text.split()
        return "\n".join(mark + " ".join(words[at:at + 10]) for at in range(0, len(words), 10))

    rows = [(f"{filler(300)}\n{body}\n{filler(40)}", {name}) for name, body in bodies.items()]
    header = {name: licenses.HEADERS[name][0] for name in ("GPL-2.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "AGPL-3.0-only", "CC0-1.0")}
    header |= {"GPL-3.0-only": licenses.TEMPLATES["GPL-3.0-only"][1], "MIT": licenses.TEMPLATES["MIT"][1], "Apache-2.0": licenses.TEMPLATES["Apache-2.0"][2]}
    rows += [(f"x = 1\n{commented(text, mark)}\n{filler(30)}", {name}) for name, text in header.items() for mark in ("# ", " * ", "// ", "//", "-- ", ";; ")]
    rows += [(f"{a}released under the mit license{b}", {"MIT"}) for a, b in (("", ""), ("", "!"), ("(", ")"), ("“", "”."), ("see: ", ", and"))]
    rows += [("Licensed under CC BY-SA 4.0", {"CC-BY-SA-4.0"}), (filler(50), set()), ("", set()), (None, set()), ("# // -- *", set())]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    df.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got, places = {}, {}
    for r in queries.op8_license_scans(spark, str(tmp_path)).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
        places[r.doc_id] = (r.first_word, r.end_word)
    wrong = {i: (text[:60] if text else text, want, got.get(i, set())) for i, (text, want) in enumerate(rows) if got.get(i, set()) != want}
    assert not wrong, wrong
    # places count the words between white space, comment marks too
    assert all(0 <= lo < hi <= len(rows[i][0].split()) for i, (lo, hi) in places.items())
