from deedflow.llm import html_main

LONG = "A long paragraph, with commas, that runs on and on, " * 8


def test_all_of_an_article_with_sections_is_kept():
    long = "".join(f"<p>{i} {LONG}</p>" for i in range(8))
    rest = "<section><p>Short one.</p></section><ul><li>item</li></ul><blockquote>Quoted.</blockquote><h4>Head</h4><table><tr><td>cell</td></tr></table>"
    want = [f"{i} {LONG.strip()}" for i in range(8)] + ["Short one.", "item", "Quoted.", "Head", "cell"]
    for tag in ("article", "main"):
        page = f"<div><p>outside</p></div><{tag}><section>{long}</section>{rest}<aside>noise</aside></{tag}><div>also outside</div>"
        assert html_main.main_text(page).split("\n") == want
