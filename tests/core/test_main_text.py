"""Running text by density: menus go, short paragraphs between good ones stay."""

from corpuskiln.operators import main_text

COMMON = ["the", "of", "and", "to", "in", "is", "it"]
LONG = "the story of it is in the middle and goes to the end " * 5
MIDDLE = "the story of it is in the middle and goes to the end of it and on to the next"
RARE = "quartz jigsaw vexed blimp nymph glyph waltz dwarf fjord quick zephyr sphinx " * 4


def texts(spark, pages, common=COMMON):
    rows = spark.createDataFrame([(i, h, "clash", 1) for i, h in enumerate(pages)], "page_id long, html string, text string, row int")
    return {r["page_id"]: (r["text"].split("\n") if r["text"] else [], r["n_blocks"], r["n_good"]) for r in main_text.main_text(rows, common=common).collect()}


def test_menus_go_and_short_paragraphs_between_good_ones_stay(spark):
    menu = "".join(f'<li><a href="/{k}">the page of {k}</a></li>' for k in range(8))
    page = f"<html><head><title>short title</title></head><body><ul>{menu}</ul><p>{LONG}</p><p>It is so.</p><p>{LONG}</p><div>short foot</div><p>{RARE}</p><script>var a = '<p>{LONG}</p>'</script></body></html>"
    ((got, n, good),) = texts(spark, [page]).values()
    assert got == [LONG.strip(), "It is so.", LONG.strip()] and (n, good) == (14, 3)


def test_links_over_several_blocks_and_neighbours(spark):
    over = f'<p>{LONG}</p><a href="x"><div>{LONG}</div><div>{LONG}</div></a><p>{LONG}</p>'
    assert texts(spark, [over])[0] == ([LONG.strip()] * 2, 4, 2)
    near = f"<p>{RARE}</p><p>{MIDDLE}</p><p>{RARE}</p><p>{MIDDLE}</p><p>{LONG}</p>"
    assert texts(spark, [near])[0][0] == [MIDDLE, LONG.strip()]  # nearly good between bad ones goes
    open_ = f"<p>{RARE}</p><p>Short one.</p><p>{LONG}</p><p>Other <a>short</a> one</p>"
    assert texts(spark, [open_])[0][0] == [LONG.strip()]
    beside = f"<p>{LONG}</p><p>Short one.</p><p>{MIDDLE}</p><p>{RARE}</p>"
    assert texts(spark, [beside])[0][0] == [LONG.strip(), "Short one.", MIDDLE]


def test_odd_pages(spark):
    pages = [None, "", "<p></p>", "just words", "<p>unclosed " + LONG, "<a href='", f"<p>{LONG}</p>", f"<p>{LONG}</p>", "<p>" * 20_000, "<a>" * 50_000 + "x", "<li><a>y</a>" * 20_000]
    got = texts(spark, pages)
    assert len(got) == len(pages) and [got[k][0] for k in (0, 1, 2, 3, 5, 8, 9, 10)] == [[]] * 8
    assert got[4][0] == ["unclosed " + LONG.strip()] and got[6] == got[7] == ([LONG.strip()], 1, 1) and got[10][1] == 20_000
    rows = spark.createDataFrame([(1, f"<p>{LONG}</p>"), (1, f"<p>{LONG}</p>"), (1, "<p>x</p>")], "page_id long, html string")
    assert sorted(r["n_good"] for r in main_text.main_text(rows, common=COMMON).collect()) == [0, 1, 1]  # rows of one id are pages of their own
    assert main_text.main_text(rows.limit(0)).count() == 0


def test_common_words_are_counted_over_all_pages(spark):
    rows = spark.createDataFrame([(i, f"<p>The b c{i}</p><p>the b</p>") for i in range(9)], "page_id long, html string")
    assert main_text.common_words(main_text.blocks(rows), 2) == ["b", "the"]
