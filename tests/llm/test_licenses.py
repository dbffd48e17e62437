import re

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from fieldloom.llm import license_rules
from fieldloom.llm import licenses as lic
from fieldloom.llm.queries import op11_licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def base(text):
    words, places, found = words_of(text), [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        found |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(found))


def every(text):
    """All detections without any prefilter."""
    words = words_of(text)
    joined, out = f" {' '.join(words)} ", set()
    for i, r in enumerate(lic.RULES):
        for m in re.finditer(f" (?:{r.pattern})(?= )", joined):
            out.add((i, joined[: m.start()].count(" "), joined[: m.end()].count(" ")))
    return out


def stays(detections):
    """The rules of resolution, pair by pair."""
    level = lambda d: license_rules.KINDS[lic.RULES[d[0]].kind][0]
    own = [d for d in detections if lic.RULES[d[0]].kind != "base"]
    within = lambda d, e: e != d and e[1] <= d[1] and d[2] <= e[2] and level(e) >= level(d) and ((e[1], e[2]) != (d[1], d[2]) or level(e) > level(d) or e[0] < d[0])
    left = [d for d in own if not any(within(d, e) for e in own)]
    kept = []
    for lv in sorted({level(d) for d in left}, reverse=True):
        kept += [d for d in left if level(d) == lv and not any(e[1] < d[2] and d[1] < e[2] for e in kept)]
    return set(kept)


def scanned(texts):
    ready = lic.scanner()
    n_words, found = ready.scan([(t or "").encode() for t in texts])
    return n_words.tolist(), [[(d["kind"], d["label"], d["first"], d["last"] + 1, d["stays"]) for d in f] for f in found]


def expected(text):
    detections = every(text)
    kept = stays(detections)
    return sorted((lic.RULES[r].kind, lic.RULES[r].label, a, b, lic.RULES[r].kind == "base" or (r, a, b) in kept) for r, a, b in detections)


TEXTS = [
    "", None, "   ", "no such thing", "All rights reserved", "ALL-RIGHTS\n * reserved. all rights reserved", "CC  BY", "cc - by 4.0 cc/by-sa 3.0; CC BY-NC", "éall rights reserved", "all rights reservedé",
    "GNU Lesser General Public License, version 2.1 or (at your option) any later version; see the GNU General Public License.", "# SPDX-License-Identifier: GPL-3.0-or-later WITH GCC-exception-3.1",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "licensed under the MIT license license MIT", "all rights", "reserved all rights",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "Tous droits réservés. Alle Rechte vorbehalten. все права защищены", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc by " * 500, "x " * 60_000 + "general public license version 3", "copyright 2020 Some Body all rights reserved general public license",
]


def test_texts_without_prefilter_and_pair_by_pair():
    n_words, found = scanned(TEXTS)
    for t, n, f in zip(TEXTS, n_words, found):
        assert (n, sorted(f)) == (len(words_of(t)), expected(t)), t
    assert [scanned([t])[1][0] for t in TEXTS] == found


def test_rules_are_many_and_hold_their_keywords():
    assert len(lic.RULES) > 250 and sum(r.kind == "base" for r in lic.RULES) == 3
    with pytest.raises(ValueError):
        lic.read_rules("name x two words,b : two words")


@pytest.mark.parametrize("part", range(8))
def test_what_rules_match_passes_the_prefilter(part):
    for r in lic.RULES[part::8]:

        @given(st.from_regex(f"(?:{r.pattern})", fullmatch=True))
        @settings(max_examples=6, deadline=None, database=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
        def holds(text):
            joined = " ".join(words_of(text))
            if re.fullmatch(r.pattern, joined):
                assert all(k in f" {joined} " for k in r.keywords), (r, joined)
                assert sorted(scanned([joined])[1][0]) == expected(joined)

        holds()


def test_documents(spark, tmp_path):
    rows = [(i, t, "mine", 1.5) for i, t in enumerate(TEXTS)] + [(None, "cc by", "mine", 1.5), (4, TEXTS[4], "mine", 1.5)]
    spark.createDataFrame(rows, "doc_id long, text string, label string, score double").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = op11_licenses(spark, str(tmp_path)).collect()
    key = lambda r: repr(tuple(r))
    want = []
    for d, t, *_ in rows:
        e = expected(t)
        labels = sorted({x[1] for x in e if x[4]})
        want.append((d, *base(t), ",".join(labels), max((license_rules.KINDS[x[0]][1] for x in e if x[4]), default=0.0)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    kept = lic.scan(spark.read.parquet(str(tmp_path / "documents.parquet"))).where("doc_id = 8").first()
    assert kept.label == "mine" and kept.found == []
    assert lic.scan(spark.read.parquet(str(tmp_path / "documents.parquet")).limit(0)).count() == 0
    assert sorted(map(key, got)) == sorted(map(key, op11_licenses(spark, str(tmp_path)).repartition(5).collect()))
