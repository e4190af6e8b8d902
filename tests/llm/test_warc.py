"""Archives that the salvage reader has to read whole."""

from __future__ import annotations

from cartpulse.llm import warc


def test_page_with_a_long_url(frame):
    url = "data:text/html," + "x" * (1 << 20)
    pages = frame("page_id bigint, url string, html string", [(1, url, "a"), (2, "u", "b")])
    assert sorted(r.page_id for r in warc.round_trip(pages).collect()) == [1, 2]
    whole = [warc.record(i, url, b"p", "d", None) for i in range(3)]
    lost = whole[1].replace(b"\r\n\r\n", b"")  # its header has no end
    found = list(warc.salvage(whole[0] + lost + b"\r\n" + whole[2]))
    assert [f[2]["page-id"] for f in found if isinstance(f[2], dict)] == ["0", "2"]
    assert sum(f[1] for f in found) == len(whole[0] + lost + whole[2]) + 2


def test_member_of_several_records():
    whole = [warc.record(i, "u", b"payload %d" % i, "d", None) for i in range(4)]
    broken = whole[1].replace(b"payload", b"pAyload")
    data = warc.member(whole[0] + broken + whole[2]) + warc.member(whole[3])
    found = list(warc.salvage(data))
    assert [f[2]["page-id"] if isinstance(f[2], dict) else f[2] for f in found] == [
        "0", "block digest differs", "2", "3"
    ]
    assert sum(f[1] for f in found) == len(data)
