"""First records by bounded reads, and what is wrong with a file."""

import io

import pytest

from visitlake.sources import csv_files, heads


class Counted(io.BytesIO):
    """A file that tells how many bytes were asked of it."""

    taken = 0

    def read(self, size=-1):
        data = super().read(size)
        self.taken += len(data)
        return data


@pytest.mark.parametrize(
    ("content", "head"),
    [
        (b"a,b\n1,2\n", b"a,b\n"), (b"a,b", b"a,b"), (b"", b""), (b"\n\r\na,b\r\n1,2\r\n", b"\n\r\na,b\r\n"),
        (b'a,"b\nc",d\n1,2,3\n', b'a,"b\nc",d\n'), (b'"a ""x""\n","b"\n1', b'"a ""x""\n","b"\n'), (b'a 5" b,c\n1\n', b'a 5" b,c\n'),
        (b'"open\n and never closed', b'"open\n and never closed'),
    ],
)
def test_first_record(content, head, monkeypatch):
    assert heads.read_head(io.BytesIO(content))[0] == head
    for step in range(1, 9):  # a step may end anywhere
        monkeypatch.setattr(heads, "STEP", step)
        assert heads.read_head(io.BytesIO(content))[0] == head


def test_no_more_than_two_steps_behind_the_first_record_are_read():
    file = Counted(b"a,b,c\n" + b"1,2,3\n" * 10_000_000)
    assert heads.read_head(file) == (b"a,b,c\n", heads.STEP) and file.taken == heads.STEP
    wide = Counted(b"x" * 100_000 + b"\n" + b"y\n" * 10_000_000)
    head, size = heads.read_head(wide)
    assert len(head) == 100_001 and size == wide.taken <= 2 * len(head) + 2 * heads.STEP


def test_a_first_record_without_end_is_refused(monkeypatch):
    monkeypatch.setattr(heads, "LONGEST_HEAD", 100_000)
    file = Counted(b'"' + b"x" * 1_000_000)
    head, _, reason = heads.told("f", lambda _: file)
    assert head is None and "no end of the first record" in reason and file.taken < 300_000


def test_reasons_by_file(spark, tmp_path):
    files = {
        "good": b"a,b\n1,2\n", "quoted": b'"a\nx",b\n1,2\n3,4\n', "latin": "é,b\n1,2\n".encode("latin-1"), "packed": b"PK\x03\x04\0\0\n",
        "nothing": b"", "blank": b"\n\n", "headless": b",,\n1,2,3\n",
    }
    for name, content in files.items():
        (tmp_path / f"{name} 1.csv").write_bytes(content)
    (tmp_path / "gone.csv").symlink_to(tmp_path / "nowhere")
    found = {f.name.split(" ")[0]: f for f in csv_files.discover(spark, str(tmp_path))}
    assert {n: f.reason for n, f in found.items() if n in files} == {
        "good": None, "quoted": None, "latin": heads.UNDECODABLE, "packed": heads.UNDECODABLE,
        "nothing": heads.NO_HEADER, "blank": heads.NO_HEADER, "headless": heads.NO_HEADER,
    }
    assert found["quoted"].header == ("a\nx", "b") and found["good"].header == ("a", "b")
    rows = csv_files.read_files(spark, list(found.values())).select("b").collect()
    assert sorted(r[0] for r in rows) == ["2", "2", "4"]


def test_a_file_that_cannot_be_opened_has_a_reason(tmp_path):
    head, size, reason = heads.told(str(tmp_path / "none.csv"))
    assert (head, size) == (None, 0) and "FileNotFoundError" in reason
    with pytest.raises(heads.Unreachable):
        heads.told("nosuchstore://x/y.csv")


def test_paths_that_only_spark_opens_are_read_by_spark(spark, tmp_path, monkeypatch):
    for name, content in {"one": "a,b\n1,2\n", "two": "b\n3\n"}.items():
        (tmp_path / f"{name}.csv").write_text(content)
    assert csv_files._first_lines(spark, [str(tmp_path / "one.csv"), str(tmp_path / "two.csv")]) == {"one.csv": "a,b", "two.csv": "b"}
