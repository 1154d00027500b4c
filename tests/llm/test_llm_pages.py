from thermoweave.llm.pagetext import extract, main_text, page_report

FILL = "long enough to be an article " * 6


def test_marked_article_between_frame():
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var a='</p><p>no';</script></head><body><nav><ul>"
        "<li><a href=x>Home</a></ul></nav><!-- <p>no</p> --><div class='ad'>Buy</div><article><h1>Head&amp;line</h1>"
        f"<p>{FILL}<br>Of. <p>Tom &lt;b&gt; &#233;\n\n x</p><aside>side</aside><form><p>mail us</p></form>"
        "<div class='comments'><p>first!</p></div><p>End</article><footer>&copy; me"
    )
    assert main_text(page) == f"Head&line {FILL.strip()} Of. Tom <b> é x End"


def test_unmarked_page_by_line_blocks():
    page = (
        "<body><div><a>One</a></div><div><a>Two</a></div><div><a>Three</a></div><div><a>Four</a></div>"
        f"<h2>Title</h2><p>Short.</p><p>{FILL}</p><p>see <a>this</a> too</p><div class='cookie-notice'>We use</div><p>Last.</p>"
        "<ul><li><a>a</a></li><li><a>b</a></li><li><a>c</a></li><li><a>d</a></li></ul><p>x</p></body>"
    )
    assert main_text(page) == f"Title Short. {FILL.strip()} see this too Last."


def test_links_of_an_article_are_its_text():
    links = "".join(f"<li><a href=x>Part {i}</a></li>" for i in range(5))
    page = (
        f"<nav><a>Home</a></nav><article><h1><a href=x>Title</a></h1><ul>{links}</ul><p>{FILL}</p><ul>{links}</ul>"
        f"<p>End</p><div class='ad'><a>Buy</a></div><p><a href=x>Source</a></p></article><footer>f</footer>"
    )
    parts = " ".join(f"Part {i}" for i in range(5))
    assert main_text(page) == f"Title {parts} {FILL.strip()} {parts} End Source"
    assert main_text("<article><p><a>Only a link</a></p></article>") == "Only a link"


def test_articles_are_evidence_only():
    body = f"<div><h1>Title</h1><p>{FILL}</p><p>{FILL}</p></div>"
    whole = f"Title {FILL.strip()} {FILL.strip()}"
    assert main_text(f"{body}<article><h2>Teaser short</h2></article>") == whole
    assert main_text(f"<article><h2>Teaser</h2><p>of some other story, in words that fill a line</p></article>{body}") == whole
    assert main_text(f"<main><ul><li><a>Home</a><li><a>About</a></ul></main>{body}") == whole
    assert main_text(f"<article>{body}</article><article><h2>Other</h2><p>{FILL[:70]}</p></article>") == whole
    assert main_text(f"<article>{body}</article><article>{body}</article>") == f"{whole} {whole}"
    assert main_text(f"<p>{FILL[:100]}</p><article>{body}</article><p>{FILL[:100]}</p>") == whole
    assert main_text("<article><p>Short.</p><div class='ad'>Buy<p>it</p><p>now</p></div><p>End.</p></article>") == "Short. End."


def test_menu_inside_main():
    menu = "<nav><ul><li><a>Home</a><li><a>About</a></ul></nav>"
    assert main_text(f"<main>{menu}<p>{FILL}</p><div class='related'><p>{FILL}</p></div><p>End</p></main>") == FILL.strip() + " End"


def test_short_end_behind_frame_lines():
    frame = "<div class='ad'><p>Buy</p><p>this</p><p>now</p><p><a>here</a></p></div>"
    links = "".join(f"<p><a>{x}</a></p>" for x in "abcd")
    assert main_text(f"<p>First.</p>{frame}<p>{FILL}</p>{frame}<p>Last.</p>{links}<p>x</p>") == f"First. {FILL.strip()} Last."


def test_head_and_option_without_end_tags():
    head = "<html><head><meta charset=x><title>T</title><script>var a = '<body>'</script><style>p{}</style>"
    for rest in (f"<body><p>{FILL}</body>", f"<p>{FILL}", FILL, f"</head><body><p>{FILL}"):
        assert main_text(head + rest) == FILL.strip()
    assert main_text(f"<datalist><option value=a>A<option>B</datalist><p>{FILL}") == FILL.strip()


def test_names_that_only_sound_like_frame():
    for name in ("content-with-sidebar", "elementor-widget elementor-widget-text-editor", "related-work", "modal"):
        assert main_text(f"<div class='{name}'><p>{FILL}</p></div>") == FILL.strip()
        if name != "modal":
            page = f"<article><p>{FILL}</p><section id='{name}'><p>Part</p></section></article>"
            assert main_text(page) == FILL.strip() + " Part"
    for name in ("related-posts", "ad-slot", "cookie-notice", "comments-section", "main-sidebar", "widget"):
        assert main_text(f"<p>{FILL}</p><div class='{name}'><p>Junk {FILL[:90]}</p></div>") == FILL.strip()
    assert main_text(f"<p>{FILL}</p><div class='comments'><p>{FILL * 3}</p></div>") == FILL.strip()


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<script>only") == main_text("<nav>x</nav>") == ""
    assert main_text("plain text, no markup") == "plain text, no markup"
    assert main_text("a < b <p>c") == "a < b c"
    assert len(main_text("<p>" + "word " * 100_000)) == 499_999


def test_frame_keeps_other_columns(spark):
    rows = [(1, "u", f"<article><p>{FILL}</article>", "old", 5), (1, "u", None, None, None), (None, None, "", "t", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = extract(pages).collect()
    assert sorted((r.n_chars, r.text) for r in got) == [(0, ""), (0, ""), (len(FILL.strip()), FILL.strip())]
    assert page_report(pages).columns == ["page_id", "url", "text", "n_chars"]
    assert page_report(pages.limit(0)).count() == 0
