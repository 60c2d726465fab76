"""Labelled pages that teach the extraction model designs the corpus may not show."""

from __future__ import annotations

# Small hand-labelled layouts. An attribute y="1" or y="0" labels an element and all
# below it, down to the next such attribute. {t} is a paragraph, {s} a short phrase, {a} a link.
LAYOUTS = (
    """<body y="0"><header class="site-header"><h1>{s}</h1><p>{s}</p></header><nav class="menu"><ul><li>{a}</li>
    <li>{a}</li><li>{a}</li></ul></nav><main y="1"><article><header><h1>{s}</h1><p class="byline">{s}</p></header>
    <p>{t}</p><p>{t}</p><h2>{s}</h2><p>{t}</p><ul><li>{t}</li><li>{s}</li></ul><blockquote><p>{t}</p></blockquote>
    <aside y="0" class="related"><h3>{s}</h3><ul><li>{a}</li><li>{a}</li></ul></aside>
    <footer y="0"><p>{a} {a}</p></footer></article></main>
    <aside class="sidebar"><h3>{s}</h3><p>{t}</p><ul><li>{a}</li></ul></aside>
    <section id="comments" class="comments"><h2>{s}</h2><article class="comment"><p>{t}</p></article>
    <article class="comment"><header>{s}</header><p>{t}</p></article>
    <form class="comment-form"><p>{s}</p></form></section><footer class="site-footer"><p>{t}</p></footer></body>""",
    """<body y="0"><div id="header"><div class="logo">{a}</div><div class="nav">{a} {a} {a}</div></div>
    <div class="cookie-notice"><p>{t}</p></div><div id="wrapper"><div id="content" class="content" y="1">
    <h1>{s}</h1><p>{t}</p><div y="0" class="ad">{t}</div><p>{t}</p><p>{t}</p><h3>{s}</h3><p>{s}</p>
    <table><tr><td>{s}</td><td>{s}</td></tr></table><div y="0" class="share social">{a} {a}</div></div>
    <div id="sidebar"><div class="widget"><h4>{s}</h4><p>{t}</p><ul><li>{a}</li><li>{a}</li></ul></div></div>
    <div class="comments"><ul><li><p>{t}</p></li><li class="comment"><div>{t}</div></li></ul></div></div>
    <div id="footer">{s} {a}</div></body>""",
    """<body y="0"><div class="top-bar notice"><p>{t}</p></div><div class="header"><p>{s}</p></div>
    <div class="breadcrumb">{a} {a}</div><div class="post" y="1"><h2 class="title">{s}</h2>
    <div class="post-body entry"><p>{t}</p><p>{t}</p><pre>{s}</pre><p>{t}</p><figure><figcaption>{s}</figcaption></figure>
    </div><form y="0" class="newsletter subscribe"><p>{t}</p></form></div>
    <div class="advert sponsored banner"><p>{t}</p></div><div class="related-posts"><h3>{s}</h3><div>{a}</div></div>
    <div id="disqus" class="replies"><div class="reply"><p>{t}</p></div></div>
    <div class="footer legal"><p>{t}</p><p>{s} {a}</p></div></body>""",
    """<body y="0"><nav>{a} {a}</nav><div class="alert warning"><p>{t}</p></div>
    <form class="search login"><p>{s}</p><div>{s}</div></form><section class="story article-body text" y="1"><h1>{s}</h1>
    <p>{t}</p><ol><li>{t}</li><li>{t}</li></ol><p>{t}</p><dl><dt>{s}</dt><dd>{t}</dd></dl></section>
    <section class="promo popular"><h2>{s}</h2><p>{t}</p></section><div class="consent gdpr popup modal"><p>{t}</p></div>
    <div class="pagination">{a} {a}</div><footer><div>{s}</div><ul><li>{a}</li></ul></footer></body>""",
    """<body y="0"><header><div>{s}</div><nav><ul><li>{a}</li><li>{a}</li></ul></nav></header>
    <div class="ad">{t}</div><div class="ads">{s}</div><article y="1"><h1>{s}</h1><p>{t}</p><p>{s}</p><p>{t}</p></article>
    <div class="menu">{s} {a}</div><div class="sidebar"><p>{t}</p></div><div class="user-comments"><p>{t}</p><p>{s}</p></div>
    <div class="copyright">{s}</div><footer>{t}</footer></body>""",
    """<body y="0"><div><ul><li>{a}</li><li>{a}</li><li>{a}</li></ul></div><div y="1"><h1>{s}</h1><p>{t}</p><p>{t}</p>
    <p>{t}</p></div><div><p>{s} {a}</p></div></body>""",
    """<body y="1"><h1>{s}</h1><p>{t}</p><p>{t}</p><ul y="0" class="nav"><li>{a}</li><li>{a}</li></ul></body>""",
    """<h1 y="1">{s}</h1><p y="1">{t}</p><p y="1">{t}</p>""",
    """<h1 y="1">{s}</h1>{t}<br>{t}<ul y="1"><li>{s}</li></ul>{t}""",
    """{t}<p y="1">{t}</p>{s}. {t}<div y="0" class="ad">{t}</div>{s}""",
    """<body y="0"><article y="1"><h1>{s}</h1><p>{t}</p><aside y="0">{t}</aside><div y="0" class="notice">{t}</div>
    <form y="0"><div>{s}</div><p>{t}</p></form><p>{t}</p><nav y="0">{a} {a}</nav></article><aside>{t}</aside>
    <section class="comments"><article><p>{t}</p><p>{s}</p></article></section><header>{t}</header>
    <nav><p>{t}</p></nav></body>""",
)

PARAGRAPHS = (
    "The river rose in the night, and by the morning most of the lower fields, which had been sown "
    "only a week before, were under water. Nobody in the village had seen it so high, they said.",
    "What the survey found was not what its authors had expected. Of the two hundred people asked, "
    "nearly half had never used the service, and the rest were divided about its worth.",
    "Each part has to be cleaned before it is fitted. Use a soft cloth, and take care that no dust "
    "is left on the lens, since it cannot be reached later without opening the case again.",
)
PHRASES = ("A short line", "Notes on the season", "What comes next", "Read before use")
LINK_WORDS = ("Home", "News", "About us", "Contact", "More stories", "Archive")


def labelled_pages() -> list[str]:
    """The layouts, each filled with every choice of paragraph."""
    pages = []
    for number, layout in enumerate(LAYOUTS):
        for shift, paragraph in enumerate(PARAGRAPHS):
            phrase = PHRASES[(number + shift) % len(PHRASES)]
            word = LINK_WORDS[(number + shift) % len(LINK_WORDS)]
            pages.append(
                layout.replace("{t}", paragraph)
                .replace("{s}", phrase)
                .replace("{a}", f'<a href="/x">{word}</a>')
            )
    return pages
