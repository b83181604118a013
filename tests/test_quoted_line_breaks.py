import pytest

from kinfold.sources.delimited import read_delimited
from kinfold.sources.loader import load_dataframe

HEAD = "\t".join("abcdefg")


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('a,b,c\n1,"x\ny",2\n3,4\n5,6,7,8\n9,0,"p\n\nq ""r"", s"\n', [("1", "x\ny", "2"), ("3", "4", None), ("9", "0", 'p\n\nq "r", s')]),
        (f'note\n\nmore\n{HEAD}\n1\t"x\ny"\t3\t4\t5\t6\t"7\n8"\n2\n', [("1", "x\ny", "3", "4", "5", "6", "7\n8"), ("2", *[None] * 6)]),
    ],
)
def test_line_breaks_are_read_or_refused(spark, tmp_path, text, want):
    (tmp_path / "d.csv").write_text(text)
    path = str(tmp_path / "d.csv")
    got = read_delimited(spark, path, multi_line=True)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert load_dataframe(spark, path, multi_line=True).count() == len(want)
    with pytest.raises(Exception, match="goes on in the next line"):
        read_delimited(spark, path).collect()


def test_break_in_the_last_column_is_refused(spark, tmp_path):
    (tmp_path / "d.csv").write_text('a,b\n1,"x\n2,y"\n')
    with pytest.raises(ValueError, match="1 lines of .*d.csv"):
        read_delimited(spark, str(tmp_path / "d.csv"))
    got = read_delimited(spark, str(tmp_path / "d.csv"), multi_line=True)
    assert [tuple(r) for r in got.collect()] == [("1", "x\n2,y")]
