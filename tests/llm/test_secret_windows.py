"""Entropy limits and the allow list judge windows, not whole candidates."""

import random

from rubric.llm import secret_scan


def test_windows_are_judged_by_their_own_class(spark):
    rng = random.Random(7)
    draw = lambda alphabet, n: "".join(rng.choices(alphabet, k=n))
    hexes = [draw("0123456789ABCDEF", n) for n in (32, 40) for _ in range(40)]
    alnum = [draw(secret_scan.ALPHABET[:62], 36) + "7a" for _ in range(20)]
    blob = draw(secret_scan.ALPHABET[:62], 300) + "1234567" + draw(secret_scan.ALPHABET[:62], 300)
    texts = [*("key=" + h if len(h) == 32 else "id_" + h for h in hexes), *(f"/sample-bucket/{k}" for k in alnum), blob]
    calm = ["/usr/share/internationalization/of-the-second-2-example", "order_12345678901234567890", "/a/example" + alnum[0],
            "123e4567-e89b-12d3-a456-426614174000", "abcdefghijklmnopqrstuvwxyz0123456789", "your-" + alnum[1], ""]
    df = spark.createDataFrame(list(enumerate(texts + calm)), "doc_id long, text string").repartition(4)
    spans = {r.doc_id: r.spans for r in secret_scan.secret_report(df).collect()}
    missed = sum(not spans[i] for i in range(len(hexes)))
    assert missed <= 2
    for i in range(len(hexes), len(texts)):
        assert spans[i], texts[i]
    assert spans[len(texts) - 1].split(",")[0].split(":")[1] == "0" and len(spans[len(texts) - 1].split(",")) == 2
    # the match itself and its windows stay out of every span
    assert [spans[len(texts) + i] for i in (0, 1, 2, 3, 4, 6)] == [""] * 6
    clean = {r.doc_id: r.text for r in secret_scan.redact(df).collect()}
    assert clean[len(hexes)].startswith("/sample") and alnum[0] not in clean[len(hexes)]


def entropy(w):
    import math
    return -sum(w.count(c) / len(w) * math.log2(w.count(c) / len(w)) for c in set(w))


def kind(ch):
    return "d" if ch.isdigit() else "l" if ch.islower() else "u" if ch.isupper() else ""


def window_spans(text):
    """Entropy spans by judging every window anew."""
    import re
    out = []
    for m in re.finditer(secret_scan.CANDIDATE, text):
        c = m[0]
        if not re.search("[0-9]", c) or not re.search("[A-Za-z]", c) or re.match(secret_scan.UUID, c):
            continue
        limit = (secret_scan.HEX_BITS if re.fullmatch("[0-9a-f]+|[0-9A-F]+", c) else
                 secret_scan.ALNUM_BITS if re.fullmatch("[A-Za-z0-9]+", c) else secret_scan.BASE64_BITS)
        allowed = [a.span() for a in re.finditer(secret_scan.ALLOWED, c)]
        allowed += [r.span() for r in re.finditer("[A-Za-z0-9]+", c)
                    if len(r[0]) <= secret_scan.PLACEHOLDER and any(a < r.end() and r.start() < b for a, b in allowed)]
        spans = []
        for i in range(len(c) - 19):
            w = c[i:i + 20]
            own = (None if not re.search("[0-9]", w) or not re.search("[A-Za-z]", w) else
                   min(limit, secret_scan.HEX_BITS) if re.fullmatch("[0-9a-f]+|[0-9A-F]+", w) else
                   min(limit, secret_scan.ALNUM_BITS) if re.fullmatch("[A-Za-z0-9]+", w) else limit)
            mixed = [{kind(a), kind(b)} for a, b in zip(w, w[1:]) if kind(a) != kind(b) and kind(a) and kind(b)]
            few = len(mixed) < secret_scan.MIXED or sum("d" in m for m in mixed) < secret_scan.DIGIT_MIXED
            if own is None or few or any(a < i + 20 and i < b for a, b in allowed):
                continue
            if entropy(w) >= own - 1e-9:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + 20
                else:
                    spans.append([i, i + 20])
        out += [(m.start() + a, m.start() + b) for a, b in spans]
    return out


def test_entropy_spans_equal_a_scan_of_all_windows(spark):
    rng = random.Random(13)
    bits = ["sample", "xxxx", "-", "_", "/", "=", "2024", "word", "Camel", "deadbeef00", "0000000", " ", "é "]
    texts = []
    for _ in range(400):
        parts = [rng.choice(bits) if rng.random() < 0.5 else "".join(rng.choices(secret_scan.ALPHABET, k=rng.randint(1, 45))) for _ in range(rng.randint(1, 6))]
        texts.append("".join(parts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = 0
    for r in secret_scan.secret_report(df).collect():
        text = texts[r.doc_id]
        spans = [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("entropy")]
        base = [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s and not s.startswith("entropy")]
        want = [(a, b) for a, b in window_spans(text) if not any(x < b and a < y for x, y in base)]
        assert spans == want, text
        found += len(want)
    assert found > 200


CALM = ["2024/03/how-to-install-linux-on-your-laptop", "step_1_download_the_public_dataset_from_source", "isbn-13-978-0-306-40615-7-hardcover",
        "src/main/java/org/apache/hadoop/fs/v2/FileSystem2", "2023-11-05_14-22-07_backup_of_home_folder", "release-2024-04-v1-final-draft-2",
        "assets/images/2019/07/IMG_20190714_183022", "phone_0049-30-1234-5678_extension_12", "covid-19-vaccination-rates-by-country-2021",
        "wp-content/uploads/2018/05/header-image-2", "ABC-12345-DEF-67890-GHI-24680-JKL", "thisIsAVeryLongCamelCaseIdentifierName2"]


def test_ordinary_strings_stay_and_random_keys_go(spark):
    rng = random.Random(21)
    keys = (["".join(rng.choices(secret_scan.ALPHABET[:62], k=32)) for _ in range(200)]
            + ["".join(rng.choices(secret_scan.ALPHABET[:64], k=40)) for _ in range(200)]
            + ["K" + "".join(rng.choices("0123456789ABCDEF", k=40)) for _ in range(100)])
    df = spark.createDataFrame(list(enumerate(CALM + keys)), "doc_id long, text string").repartition(4)
    spans = {r.doc_id: r.spans for r in secret_scan.secret_report(df).collect()}
    assert [CALM[i] for i in range(len(CALM)) if spans[i]] == []
    missed = sum(not spans[len(CALM) + i] for i in range(len(keys)))
    assert missed <= 0.02 * len(keys)
