"""A small labelled table: pages in pieces, each piece with the label of the blocks that end in it.

``True`` is the article, ``False`` the rest. Written by hand for this library, for designs that differ in their markup.
"""

_P = "The council met on Monday, and after a long debate it agreed to repair the old bridge before the winter."
_Q = "Nobody expected the rain to last so long; the fields stood under water for weeks, and the harvest was late."
_R = "She said that the work would begin in spring. It will cost less than last year, according to the report."
_LINKS = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in "news sport culture weather contact".split())

PAGES: list[list[tuple[bool, str]]] = [
    [  # an article with an advert and a navigation list
        (False, f"<html><head><title>Bridge</title></head><body><nav><ul>{_LINKS}</ul></nav>"),
        (False, '<div class="ad">Buy two pairs of shoes now and get the third one for free.</div>'),
        (True, f"<article><h1>Old bridge to be repaired</h1><p>{_P}</p><p>{_Q}</p><p>Why?</p><p>{_R}"),
        (False, "</article><footer>&copy; The Daily, all rights reserved.</footer>"),
    ],
    [  # containers with telling class names only
        (False, f'<body><div id="header"><a href="/">The Daily</a> news since 1920</div><div class="menu"><ul>{_LINKS}</ul></div>'),
        (True, f'<div class="post-content"><h2>Rain</h2><div>{_Q}</div><div>{_P}</div><ul><li>late harvest</li><li>wet fields</li></ul>'),
        (False, f'<div class="share-buttons">Share this on <a href="#">one</a> <a href="#">two</a></div></div><div class="sidebar"><h3>Most read</h3><p>{_R}</p><ul>{_LINKS}</ul></div>'),
        (False, f'<div id="comments"><h3>Two comments</h3><div><b>Ann</b><p>{_R}</p></div><div><b>Bo</b><p>I do not think so, it was dry last year.</p></div></div>'),
        (False, '<div class="footer">Imprint and privacy</div>'),
    ],
    [  # a header inside the article, a form and a list of links after it
        (False, '<header><a href="/">Home</a> <a href="/about">About us</a></header><div class="cookie-banner"><p>We use cookies to make this site better, please agree.</p></div>'),
        (True, f"<main><article><header><h1>Spring work</h1><p>By Ann Miller</p></header><p>{_R}</p><blockquote>{_Q}</blockquote><h2>What comes next</h2><p>{_P} See <a href='/b'>the plan</a> for more.</p><p>Soon.</p>"),
        (False, f'<ul class="related">{_LINKS}</ul></article></main>'),
        (False, f'<form action="/subscribe"><label>Your address</label><p>Get our letter every week.</p></form><aside><h4>Also of interest</h4><p>{_Q}</p></aside>'),
        (False, "<footer><p>Printed on paper.</p><p>Write to us.</p></footer>"),
    ],
    [  # no telling markup: what is left is the length and the links
        (False, '<body><div><a href="/">Start</a> | <a href="/n">News</a> | <a href="/s">Sport</a></div><div><a href="/l">Log in</a></div>'),
        (True, f"<div>{_P} {_Q} {_R}</div><div>{_Q} {_P}</div><div>It was over.</div><div>{_R} {_P} {_Q}</div>"),
        (False, '<div><a href="/1">The town that sleeps all day</a></div><div><a href="/2">Ten ways to bake bread</a></div><div>2020 The Daily</div>'),
    ],
    [  # a table page
        (False, f'<table><tr><td><a href="/a">Archive</a></td><td><a href="/m">Map</a></td></tr><tr><td><ul>{_LINKS}</ul></td>'),
        (True, f"<td><p>{_Q} {_R}</p><p>{_P} {_P}</p><p>{_R} {_Q}</p></td></tr>"),
        (False, '<tr><td><a href="/i">Imprint</a></td><td><a href="/t">Terms</a></td></tr></table>'),
    ],
    [  # paragraphs without end tags, short ones among them
        (False, f"<nav>{_LINKS}</nav><div class=advertisement>A car for every day, drive it now.</div>"),
        (True, f"<article><h1>Late</h1><p><b>Late.<br><p>{_Q}<p>No.<p>Be. It is.<p>{_P}<p>{_R}<ol><li>one thing<li>and another one</ol></article>"),
        (False, '<section class="user-comments"><p>First!</p><p>This is the best text that I have read for years, thank you.</p></section><footer>Contact</footer>'),
    ],
    [  # a page made of sections, notices and a dialog
        (False, '<div role="banner">The Weekly</div><div role="navigation"><a href="/">All</a></div><div class="notice">This shop is closed for a week, orders will be sent after it.</div>'),
        (True, f'<div class="story"><h1>Floods</h1><p>{_P}</p><p>{_Q} <a href="/x">Read the report of the engineers here</a>.</p><figure><figcaption>The bridge in May.</figcaption></figure><pre>a = 1</pre></div>'),
        (False, f'<div class="newsletter"><p>{_R}</p></div><div class="popup"><p>Stay with us, we have more for you.</p></div><div class="breadcrumbs"><a href="/">Home</a> / here</div>'),
        (False, '<div role="contentinfo"><p>All the news that is fit for you.</p></div>'),
    ],
    [  # a teaser page: hardly any article
        (False, '<aside class="widget"><h3>Tags</h3><a href="/t1">rain</a> <a href="/t2">bridge</a></aside><div class="promo"><p>Three issues for the price of one, only this week.</p></div>'),
        (True, f'<main><p>{_R}</p><p>{_P}</p><dl><dt>Start</dt><dd>in spring, if the weather is good</dd></dl><table><tr><th>Year</th><td>2020</td></tr></table></main>'),
        (False, f'<div class="comment-list"><article class="comment"><p>{_Q}</p></article><article class="comment"><p>Yes.</p></article></div>'),
    ],
    [  # links inside and a list of links at the end of an article
        (True, f'<div class="entry"><p>{_P} <a href="/a">As said</a>, {_Q}</p><p><a href="/b">The minutes of the meeting</a> are public, and anyone may read them.</p><h3>Sources</h3><p>{_R}</p></div>'),
        (False, f'<div class="pagination"><a href="/2">2</a> <a href="/3">3</a></div><div class="social"><p>Follow us.</p></div><menu>{_LINKS}</menu>'),
    ],
    [  # plain paragraphs in a body, with a line of links before and after
        (False, '<p><a href="/">Home</a> <a href="/about">About</a></p>'),
        (True, f"<h1>Notes on a walk along the river in autumn</h1><p>{_Q} {_P}</p><p>{_P}</p><p>{_R} {_Q}</p>"),
        (False, '<p><a href="/prev">Earlier</a> <a href="/next">Later</a></p>'),
    ],
    [  # an article whose headings and some paragraphs are links, a short line after one of them
        (False, '<div><a href="/">Home</a></div><div>The Weekly</div><div><a href="/all">All issues</a></div><div>Free</div>'),
        (True, f"<article><h1><a href='/me'>A bridge is repaired and nobody may cross the river</a></h1><p>Short.</p><p><a href='/o'>An older text of ours on how the bridge was built</a></p><p>It was long ago.</p>"),
        (True, f"<h2><a href='/p'>What the engineers say about the plan and its costs</a></h2><p>{_R}</p><p><a href='/q'>Here is what they wrote to the council in May</a></p><p>Yes.</p></article>"),
        (False, '<div><a href="/1">Why the harvest was late in all of the north</a></div><div>Today</div><div><a href="/2">A walk along the river in the rain of autumn</a></div><div>Yesterday</div>'),
    ],
    [  # teasers of other texts, as headings that are links, around a story
        (False, '<h3><a href="/1">A museum opens its doors after ten long years</a></h3><h3><a href="/2">The last train leaves the old station at noon</a></h3>'),
        (True, f'<section class="article-body"><p>{_P}</p><p>No.</p><h3>Then</h3><p><a href="/r">The whole report of the council can be read here</a></p><p>{_Q}</p></section>'),
        (False, '<div><h3><a href="/3">How to grow tomatoes on a very small balcony</a></h3><h3><a href="/4">Five books to read in a single rainy weekend</a></h3></div>'),
    ],
    [  # nothing but an article
        (True, f"<article><h1><a href='/me'>Short news</a></h1><p>{_P}</p><p>So it goes.</p></article>"),
    ],
    [  # a single paragraph
        (True, f"<p>{_R}</p>"),
    ],
    [  # a text without frame, ended by a short line
        (True, f"<body><h2>On rain</h2><div>{_Q}</div><div>{_R}</div><div>The end.</div></body>"),
    ],
    [  # headings that are links, inside the article
        (False, "<nav><a href='/'>Home</a></nav><header><h1>The Weekly</h1></header>"),
        (True, f"<main><h1><a href='/1'>Rain again</a></h1><p>{_Q}</p><h2><a href='/2'>The bridge</a></h2><p>{_P}</p><p>Ann Miller</p></main>"),
    ],
    [  # a notice before and an advert after, both by name only
        (False, '<div class="alert alert-info">Our office is closed on Friday.</div>'),
        (True, f'<div class="content"><p>Dear all,</p><p>{_R}</p><p>Yours, Bo</p></div>'),
        (False, '<div id="bottom-ads">A new car for a small price.</div>'),
    ],
]
