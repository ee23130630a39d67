import os

import pytest
from frames import rows

from cohortmark.sources import listing


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_exactly_the_rest_is_pending(spark, tmp_path):
    top = str(tmp_path / "out")
    put(f"{top}/a.primer3", "X=1\n=\n")
    put(f"{top}/deep/b.primer3", "")  # empty
    put(f"{top}/c.primer3", "X=1\nY")  # cut in a line
    put(f"{top}/d#1.eprimer3", "x\n")  # another step
    put(f"{top}/e.v2.primer3", "=\n")
    put(f"{top}/f.primer3/part-00000", "X=1\n")
    put(f"{top}/f.primer3/part-00001", "")
    put(f"{top}/name=g+h.primer3/part-00000.txt", "X=1\n")
    put(f"{top}/i.primer3/part-00000", "X=1\n")
    put(f"{top}/i.primer3/part-00001", "X=")  # a cut part
    put(f"{top}/j.json", '{"a": [1, 2]}\n')
    put(f"{top}/k.json", '{"a": [1, 2\n')  # half an object
    put(f"{top}/l.json", '{"a": 1}\n{"a": 2}\n')
    found = listing.outputs(spark, top)
    assert rows(found, "output", "step", "stem", "complete") == sorted(
        [
            ("a.primer3", "primer3", "a", True), ("c.primer3", "primer3", "c", False), ("d#1.eprimer3", "eprimer3", "d#1", True),
            ("e.v2.primer3", "primer3", "e.v2", True), ("f.primer3", "primer3", "f", True), ("g+h.primer3", "primer3", "g+h", True), ("i.primer3", "primer3", "i", False),
            ("j.json", None, "j", True), ("k.json", None, "k", False), ("l.json", None, "l", True),
        ],
        key=repr,
    )
    work = spark.createDataFrame([(x,) for x in ("a", "b", "c", "d#1", "e.v2", "f", "g+h", "i", "new")], "filestem string")
    assert rows(listing.pending(work, found, "primer3"), "filestem") == [("b",), ("c",), ("d#1",), ("i",), ("new",)]
    with pytest.raises(ValueError, match="unknown step"):
        listing.pending(work, found, "other")
    assert "content" not in listing.files(spark, top).columns and listing.files(spark, top).count() == 11  # without the two empty ones
