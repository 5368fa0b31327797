import re

from tests.llm.helpers import awkward_rows, empty, frame
from tidemark.llm import license


def by_hand(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in license.BASE.items():
        own = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += found
        labels |= {label} if found else set()
    notices = set()
    for label, (notice, phrases) in license.NOTICES.items():
        own = notice.split()
        for i in range(len(words)):
            at = [next(k for k in range(len(own)) if own[k : k + len(p.split())] == p.split()) for p in phrases]
            if all(words[i + k : i + k + len(p.split())] == p.split() for k, p in zip(at, phrases)):
                # found by its two rarest words, which must stand there too
                notices.add((label, tuple(words[i : i + len(own)]) == tuple(own)))
    return len(words), places, labels, notices


TEXTS = [
    "Released under the MIT License. mit-license MIT/License",
    "mit the license; apache  LICENSE apache license License",
    "general public general public license general public license, version 3",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this",
    "Permission is hereby denied, free of charge, to any person obtaining a copy of this",
    "Licensed under the Apache License, Version 2.0 (the License); licensed under CC BY-NC 4.0",
    "license license license mit", "", None, "MIT License " * 3000, "édition MIT license日本",
]


def test_places_equal_brute_force(spark):
    rows = [(1000 + i, t, None, None, None) for i, t in enumerate(TEXTS)] + awkward_rows()
    got = license.scan(frame(spark, rows)).collect()
    want = sorted(
        (str(r[0]), n, len(places), str(min(places, default=None)), str(max(places, default=None)), ",".join(sorted(labels)))
        for r in rows for n, places, labels, _ in [by_hand(r[1])]
    )
    assert sorted((str(r.doc_id), r.n_words, r.n_base, str(r.first_word), str(r.last_word), r.base_labels) for r in got) == want
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert (r.score > 0) == (r.labels != "") and 0 <= r.score <= 1
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[1003].labels == "mit-notice" and by_id[1003].score == 1
    assert by_id[1004].labels == ""
    assert by_id[1005].labels == "apache,apache-2.0,cc-by-nc"
    assert by_id[1002].labels == "gpl,gpl-3.0"


def test_whole_notices_are_found(spark):
    rows = [(1000 + i, t, None, None, None) for i, t in enumerate(TEXTS)] + awkward_rows()
    got = {r.doc_id: set(r.labels.split(",")) for r in license.scan(frame(spark, rows)).collect()}
    for r in rows:
        if r[0] is not None:
            assert {label for label, whole in by_hand(r[1])[3] if whole} <= got[r[0]]


ALTERED = [
    "Permission is hereby granted, free of charge, to any individual acquiring a copy",
    "Permission is hereby granted, free of charge, for ever",
    "Permission is hereby granted but never free of charge",
    "Redistribution and use in all compiled and binary forms are allowed",
    "Redistribution and use in source and binary forms, changed or not, is allowed",
    "Licensed by us, the Apache License, Version 2", "x licensed beneath one apache license version 2",
    "This is free code: you can redistribute it and/or modify it under the terms of any licence",
    "offered under CC BY-NC, offered under CC BY-SA",
]


def test_altered_notices_are_found_by_their_key_phrases(spark):
    for texts in [[t] for t in ALTERED] + [ALTERED + TEXTS]:
        rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
        got = {r.doc_id: r for r in license.scan(frame(spark, rows)).collect()}
        for i, text in enumerate(texts):
            _, _, labels, notices = by_hand(text)
            assert got[i].labels == ",".join(sorted(labels | {label for label, _ in notices})), text
    assert "mit-notice" in got[0].labels and got[0].score == 11 / 13 and got[2].labels == ""


def test_notices_without_their_first_words_are_found_at_the_start_of_a_file(spark):
    texts = ["you can redistribute it and or modify it under the terms", "Apache License, Version 2", "cc by nc", "binary forms"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = {r.doc_id: r.labels for r in license.scan(frame(spark, rows)).collect()}
    assert got == {0: "gpl-notice", 1: "apache,apache-2.0", 2: "cc-by-nc", 3: ""}


def test_plan_has_no_python(spark):
    plan = license.scan(frame(spark, awkward_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert license.scan(empty(spark)).count() == 0
