"""An article laid out as sibling blocks keeps them all, in page order."""

from tripkpi.llm import html_consensus as M


def block(word, n=40):
    return "<div class=part><p>" + " ".join(f"{word}{i}" for i in range(n)) + ".</p></div>"


def test_sibling_blocks_on_the_winning_path():
    links = "<div class=part>" + "".join(f"<a href=/{i}>some link number {i}</a> " for i in range(30)) + "</div>"
    page = f"<html><body><nav><a href=/>home</a></nav>{block('second')}{links}{block('first', 60)}</body></html>"
    whole = M.Page(page)
    path = whole.path(next(e for e in range(len(whole.tag)) if whole.tag[e] == "div"))
    text = M.text_of(page, path)
    assert "second39" in text and "first59" in text and text.index("second39") < text.index("first0")
    assert "link" not in text and "home" not in text
