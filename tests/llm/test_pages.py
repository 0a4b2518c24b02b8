"""Main texts of pages written by hand, in layouts that the training pages' maker doesn't have."""

import pytest

html_text = pytest.importorskip("pavestone.llm.html_text")

#: (html, paragraphs of main text)
PAGES = [
    (
        """<!doctype html><html lang=en><head><meta charset=utf-8><title>River levels - The Daily Ledger</title><script>var a = "<p>no</p>";</script></head><body class="page article-page">
<a class="skip-link" href="#content">Skip to content</a><div id="masthead"><a href="/">The Daily Ledger</a><ul class="main-nav"><li><a href="/news">News</a></li><li><a href="/sport">Sport</a></li></ul></div>
<div id="content"><article><h1>River levels fall after a week of sun</h1><p>The river fell by almost half a metre between Monday and Friday, the water board said in its weekly report. Ferries that had been stopped since the storm are running again.</p>
<figure><img src=a.jpg alt=""><figcaption>The lower landing stage on Friday morning.</figcaption></figure><p>Anglers should still take care: the current below the weir is strong, and several paths along the bank have not been cleared yet.</p>
<div class="advertisement"><p>Boots for every weather, now half price.</p></div><p>A new forecast is due on Tuesday, when engineers will also inspect the gates.</p></article></div>
<div class="sidebar"><h3>Most read</h3><ol><li><a href=1>Bakery reopens</a></li><li><a href=2>Bridge to close</a></li></ol></div><div id="footer">&copy; The Daily Ledger. <a href="/privacy">Privacy</a></div></body></html>""",
        ["River levels fall after a week of sun", "The river fell by almost half a metre between Monday and Friday, the water board said in its weekly report. Ferries that had been stopped since the storm are running again.", "The lower landing stage on Friday morning.", "Anglers should still take care: the current below the weir is strong, and several paths along the bank have not been cleared yet.", "A new forecast is due on Tuesday, when engineers will also inspect the gates."],
    ),
    (
        """<html><body><table width=100%><tr><td class=menu><a href=/>Home</a><br><a href=/faq>FAQ</a></td><td class=main><h2>How to repot a fern</h2><p>Choose a pot that is only one size larger than the old one. Ferns like to sit tightly, and wet soil around small roots rots quickly.</p>
<p>Water the plant the day before, lift it out, and shake off the loose soil. Trim roots that are brown and soft, then set it at the same height as before.</p></td></tr></table><div class=footer>Contact us</div></body></html>""",
        ["How to repot a fern", "Choose a pot that is only one size larger than the old one. Ferns like to sit tightly, and wet soil around small roots rots quickly.", "Water the plant the day before, lift it out, and shake off the loose soil. Trim roots that are brown and soft, then set it at the same height as before."],
    ),
    (
        """<body><header role=banner><h2>Kitchen notes</h2><nav aria-label=primary><ul><li><a href=a>Soups</a><li><a href=b>Bread</a></ul></nav></header><main><h1>Barley soup</h1><p>A soup for cold evenings, made in one pot.</p><h2>Ingredients</h2><ul><li>200 g pearl barley</li><li>two carrots</li><li>one litre of stock</li></ul>
<h2>Method</h2><ol><li>Fry the carrots gently for five minutes.</li><li>Add barley and stock, and simmer for forty minutes.</li></ol><section id=comments><h3>3 comments</h3><div class=comment><p>Lovely, thank you!</p></div></section></main><footer><p>Made with love. All rights reserved.</p></footer></body>""",
        ["Barley soup", "A soup for cold evenings, made in one pot.", "Ingredients", "200 g pearl barley", "two carrots", "one litre of stock", "Method", "Fry the carrots gently for five minutes.", "Add barley and stock, and simmer for forty minutes."],
    ),
    (
        """<html><head><style>p{color:red}</style></head><body><div class="cookie-banner"><p>We use cookies to improve this site.</p><button>Accept</button></div><div class="wrapper"><div class="post"><h1>Notes on a small printer</h1><div class="entry-content"><p>I bought the printer for labels, and after two weeks I can say that it does labels well &ndash; and little else.</p>
<blockquote><p>Paper feeds from the left, the manual says, which is true only if you turn the device around.</p></blockquote><p>The driver installs without questions. Printing from a phone took three attempts, two of them my fault.</p></div></div>
<div class="related-posts"><h4>You may also like</h4><p><a href=x>A better stapler</a></p></div><form class="newsletter"><p>Subscribe to our letter</p><input name=e></form></div></body></html>""",
        ["Notes on a small printer", "I bought the printer for labels, and after two weeks I can say that it does labels well – and little else.", "Paper feeds from the left, the manual says, which is true only if you turn the device around.", "The driver installs without questions. Printing from a phone took three attempts, two of them my fault."],
    ),
    (
        """<body><nav><a href=/>Start</a> <a href=/hilfe>Hilfe</a></nav><article class="hentry"><h1>Fahrplan ab Dezember</h1><p>Die Linie 7 fährt künftig alle zehn Minuten, auch am Sonntag. An der Haltestelle Markt wird ein zweiter Bahnsteig gebaut.</p><p>Wer umsteigt, sollte die neuen Zeiten beachten: Anschlüsse am Abend werden nicht mehr abgewartet.</p></article><aside><p>Werbung: Räder im Angebot</p></aside></body>""",
        ["Fahrplan ab Dezember", "Die Linie 7 fährt künftig alle zehn Minuten, auch am Sonntag. An der Haltestelle Markt wird ein zweiter Bahnsteig gebaut.", "Wer umsteigt, sollte die neuen Zeiten beachten: Anschlüsse am Abend werden nicht mehr abgewartet."],
    ),
]


def test_pages_by_hand():
    """Every paragraph of the main text is there, in order, and nothing else on most pages."""
    got = html_text.extract([h for h, _ in PAGES], html_text.fitted())
    exact, kept, wanted, extra = 0, 0, 0, 0
    for text, (_, want) in zip(got, PAGES, strict=True):
        blocks = text.split("\n\n")
        exact += blocks == want
        kept += sum(w in blocks for w in want)
        wanted += len(want)
        extra += sum(b not in want for b in blocks)
    assert kept >= 0.95 * wanted and extra <= 1 and exact >= 4, (exact, kept, wanted, extra, got)
