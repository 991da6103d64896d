"""Names of wrappers round a whole page don't empty it; the neighbours' words and links decide where no mark does."""

import pytest

from brackish.llm import html_extract

HEAD, ONE, TWO = "A heading of it", " ".join(["many plain words of the story go on here and"] * 12), " ".join(["another paragraph follows it with more of the same"] * 10)
PAGE = f"<h1>{HEAD}</h1><p>{ONE}</p><p>{TWO}</p>"


@pytest.mark.parametrize("wrap", ["<div class='content-sidebar-wrap'>%s</div>", "<div class='has-sidebar'>%s</div>", "<div class='post tags-politics'>%s</div>", "<div class='layout header-fixed'><article>%s</article></div>", "<section class='toc-enabled'>%s</section>", "<form id='aspnetForm'>%s</form>", "%s"])
def test_wrapper(wrap):
    page = "<html><body><nav><a href=x>Home</a> <a href=y>News</a></nav>" + wrap % PAGE + "<div class=sidebar><p>Read this too, it is popular with our readers today</p></div><footer>(c) 2020 all rights</footer></body></html>"
    assert html_extract.extract(page, html_extract.train())[0] == "\n".join([HEAD, ONE, TWO])


def test_links_decide_without_marks():
    links = "".join(f"<li><a href=/{i}>Section number {i}</a></li>" for i in range(8))
    page = f"<html><body><div><ul>{links}</ul></div><div>{PAGE}</div><div><a href=z>Next page</a> | <a href=w>Contact us</a></div></body></html>"
    assert html_extract.extract(page, html_extract.train())[0] == "\n".join([HEAD, ONE, TWO])
