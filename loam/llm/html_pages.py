"""Labelled pages from which the extractor learns (fixed small table).

``data-main="1"`` marks an element whose text, with that of its descendants, is
main text, ``data-main="0"`` one where it is not; unmarked elements take their
parent's mark, the root has 0.  ``data-runs`` marks the runs of text that stand
right under an element.  The attributes are never features.
"""

LOREM = (
    "The river rose slowly through the night, and by morning the meadow was under water.",
    "Nobody in the village could remember such a flood, although the older maps show one.",
    "Engineers measured the current at three places, but the results did not agree.",
    "Later in the week, the council met to decide what should be rebuilt first.",
    "Il y avait, au bord du lac, une maison que personne n'habitait plus.",
    "Die Brücke wurde im vergangenen Jahr erneuert, doch der Weg blieb gesperrt.",
    "Los vecinos pidieron ayuda, y la respuesta llegó dos días después.",
    "Prices for grain went up again; bakers, however, kept theirs as they were.",
)

_A, _B, _C, _D, _E, _F, _G, _H = LOREM

LABELLED_PAGES = [
    # news article with the usual parts
    f"""<!DOCTYPE html><html><head><title>Flood in the valley</title><meta charset="utf-8"></head><body>
<header class="site-header"><a href="/">Daily Valley</a><nav><ul><li><a href="/n">News</a></li><li><a href="/s">Sport</a></li></ul></nav></header>
<article data-main="1"><h1>Flood in the valley</h1><p>{_A} {_B}</p><p>{_C}</p><blockquote>{_D}</blockquote>
<div class="ad" data-main="0">Buy boots now.</div><ul><li>{_E}</li><li>{_F}</li></ul>
<section class="comments" data-main="0"><h3>Comments</h3><div class="comment"><p>{_G}</p></div><div class="comment"><p>I agree with this.</p></div></section></article>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Ten bridges</a></li><li><a href="/2">{_H}</a></li></ul></aside>
<footer>&copy; Daily Valley. {_B}</footer></body></html>""",
    # blog built of divs only
    f"""<html><body><div id="wrapper"><div id="header"><h2>My garden blog</h2><p>Notes on plants and weather.</p></div>
<div id="menu" class="menu"><a href="/a">Home</a> <a href="/b">About</a> <a href="/c">Archive</a></div>
<div id="content" class="post" data-main="1"><h2>On the flood</h2><p>{_A}</p><p><b>{_C}</b> {_D}</p><div class="text">{_E} {_F}</div><p>{_G}<br>{_H}</p></div>
<div id="comments"><p>Great post, thank you for it!</p><p>{_D}</p><form><label>Your name</label><input name="n"><button>Send</button></form></div>
<div class="sidebar"><p>Follow me for more.</p><ul><li><a href="/x">Tags</a></li></ul></div>
<div id="footer"><p>All rights reserved, 2020.</p></div></div></body></html>""",
    # page with a cookie notice, a banner and a newsletter form
    f"""<html><body><div class="cookie-notice" role="dialog"><p>We use cookies to make this site work. {_D}</p><button>Accept</button></div>
<div class="banner advert"><p>Cheap flights this summer. {_H}</p></div><nav><a href="/">Start</a><a href="/k">Contact</a></nav>
<main data-main="1"><h1>Bridges</h1><p>{_F} {_A}</p><h2>History</h2><p>{_B}</p><table><tr><td>{_C}</td><td>1871</td></tr></table>
<form data-main="0" class="newsletter"><p>Subscribe to our letter and never miss a story.</p><input><button>Go</button></form><p>{_G}</p></main>
<footer><p>Imprint</p><p>{_E}</p></footer></body></html>""",
    # advert before the article, inline markup, open paragraphs
    f"""<html><body><nav><ul><li><a href="/A">A</a></li><li><a href="/B">B</a></li><li><a href="/C">C</a></li></ul></nav>
<!-- ad --><div class="ad">{_G} {_H}</div><article data-main="1"><h1>{_A}</h1><p><b>{_A} {_B}<br><p>{_C}</b></p><p>{_D} <a href="/l">{_E}</a> <i>and</i> so on.</p><p>Short.</p><p>{_F}</article>
<footer>&copy; www.site.example &middot; {_C}</footer>""",
    f"""<html><body><nav><ul><li><a href="/um">um</a></li><li><a href="/zu">zu</a></li></ul></nav><div class="ad">{_F}</div>
<article data-main="1"><h1>Kurz</h1><p>{_F}</p></article><footer>&copy; {_G}</footer></body></html>""",
    # forum-like and shop-like pages
    f"""<html><body><div class="topbar nav"><a href="/">Log in</a> | <a href="/">Register</a></div><div class="notice warning"><p>Maintenance on Sunday. {_A}</p></div>
<div class="article-body" data-main="1"><p>{_H}</p><p>{_B} {_C}</p><pre>{_D}</pre></div>
<div class="related"><h4>Related stories</h4><ul><li><a href="/1">{_E}</a></li><li><a href="/2">{_A}</a></li></ul></div>
<div class="reader-comments"><ol><li><p>{_F}</p></li><li><p>{_B}</p></li></ol></div><div class="footer-links"><a href="/p">Privacy</a></div></body></html>""",
    f"""<html><body><header><h1>Shop of maps</h1><p>{_D}</p></header><div class="promo sponsored"><p>{_E}</p></div>
<section class="entry-content main" data-main="1"><h2>Old maps</h2><p>{_B}</p><p>{_G}</p><figure><img src="m.png"><figcaption>{_H}</figcaption></figure><dl><dt>Scale</dt><dd>{_C}</dd></dl></section>
<section id="disqus_thread" class="comments-area"><article class="comment"><p>{_A}</p></article><article class="comment"><p>{_F}</p></article></section>
<aside><p>{_G}</p></aside><form class="search"><p>Search the shop</p><input></form><footer><nav><a href="/t">Terms</a></nav></footer></body></html>""",
    # pages with little markup
    f"""<html><body><p data-main="1">{_A}</p><p data-main="1">{_E} {_F}</p></body></html>""",
    f"""<p data-main="1">{_B}</p>""",
    f"""<html><body><h1 data-main="1">{_C}</h1><div data-main="1">{_D} {_G}</div><div class="share"><a href="/f">Share</a><a href="/t">Post</a></div></body></html>""",
    f"""<html><body><div class="page"><div class="navigation breadcrumb"><a href="/">Home</a> &gt; <a href="/m">Maps</a></div><div class="main-content" data-main="1"><article><h1>Rivers</h1><p>{_C} {_A}</p><p>{_B}</p>
<div class="ads advertisement" data-main="0"><p>{_D}</p></div><p>{_H}</p></article></div><div class="comments" id="comments"><ul><li>{_G}</li><li>{_E}</li></ul></div><div class="copyright footer">{_F}</div></div></body></html>""",
    f"""<html><body><div class="alert notification">{_E} {_G}</div><div role="navigation"><ul><li><a href="/q">{_B}</a></li></ul></div><div role="main" data-main="1"><p>{_F}</p><p>{_D}</p></div>
<div role="contentinfo"><p>{_A}</p></div><div class="popup modal subscribe"><p>{_C}</p></div><div role="complementary" class="widget"><p>{_H}</p></div></body></html>""",
    # text right under the body
    f"""<html><body data-runs="1">{_A} {_B}<br>{_C} <b>{_D}</b> and so on.<p data-main="1">{_E}</p><div class="footer">{_G}</div></body></html>""",
    f"""<html><body data-runs="1">{_H}</body></html>""",
    f"""<html><body data-runs="1"><h1 data-main="1">Lakes</h1>{_E} <i>{_F}</i><div class="ad">{_A}</div></body></html>""",
    f"""<html><body data-runs="0">Skip | <a href="/l">Log in</a><article data-main="1"><h1>{_B}</h1><p>{_D} {_A}</p></article>Imprint<footer>{_C}</footer></body></html>""",
    f"""<html><body data-runs="0"><a href="#main">Skip to content</a><main data-main="1"><p>{_G}</p><p>{_H}</p></main>&gt;&gt;</body></html>""",
]
