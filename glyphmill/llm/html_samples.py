"""Labelled pages for training the extraction model: made here from layouts of many kinds, with invented words.

Each page is a list of (html, label) pieces; text inside a piece has the piece's label: 1 article text, 0 all else.
"""

from __future__ import annotations

import random

MENUS = ['<nav>{}</nav>', '<ul class="menu">{}</ul>', '<div id="nav">{}</div>', '<div class="navbar">{}</div>', '<nav class="breadcrumb">{}</nav>', '<div role="navigation">{}</div>', '<div class="topmenu">{}</div>']
HEADERS = ['<header>{}</header>', '<div id="header">{}</div>', '<div class="site-header">{}</div>', '<div class="masthead">{}</div>', '<div class="logo">{}</div>']
FOOTERS = ['<footer>{}</footer>', '<div id="footer">{}</div>', '<div class="site-footer">{}</div>', '<div class="copyright">{}</div>', '<footer class="legal">{}</footer>']
SIDES = ['<aside>{}</aside>', '<div class="sidebar">{}</div>', '<div id="sidebar">{}</div>', '<div class="widget">{}</div>', '<div class="related">{}</div>', '<section class="recommended">{}</section>', '<div class="tags">{}</div>', '<div class="share">{}</div>', '<div class="social">{}</div>']
ADVERTS = ['<div class="ad">{}</div>', '<div class="ads">{}</div>', '<div class="advert">{}</div>', '<div id="advertisement">{}</div>', '<aside class="sponsored">{}</aside>', '<div class="promo">{}</div>', '<div class="banner">{}</div>', '<section class="ad">{}</section>', '<p class="ad">{}</p>']
NOTICES = ['<div class="cookie">{}</div>', '<div class="cookie-notice">{}</div>', '<div class="notice">{}</div>', '<div class="alert">{}</div>', '<div id="consent">{}</div>', '<div role="alert">{}</div>', '<p class="notice">{}</p>', '<div class="popup">{}</div>', '<dialog>{}</dialog>', '<div class="disclaimer">{}</div>', '<div class="modal">{}</div>']
COMMENTS = ['<div class="comments">{}</div>', '<div id="comments">{}</div>', '<section class="comments">{}</section>', '<ol class="comment-list">{}</ol>', '<section id="reader-comments">{}</section>', '<div class="replies">{}</div>', '<div class="comment">{}</div>', '<article class="comment">{}</article>', '<div class="discussion">{}</div>']
FORMS = ['<form>{}</form>', '<form class="search">{}</form>', '<div class="newsletter">{}</div>', '<div class="subscribe">{}</div>', '<form id="login">{}</form>', '<fieldset>{}</fieldset>']
BODIES = [('<article>', '</article>'), ('<main>', '</main>'), ('<div class="content">', '</div>'), ('<div class="post">', '</div>'), ('<div class="article-body">', '</div>'), ('<div id="main">', '</div>'), ('<div class="entry">', '</div>'), ('<section class="story">', '</section>'),
          ('<main><article>', '</article></main>'), ('<div class="text"><article>', '</article></div>'), ('<div id="content"><div>', '</div></div>'), ('<div role="main">', '</div>'), ('<div class="wrapper"><main>', '</main></div>'), ('<article class="post">', '</article>'), ('<div><article>', '</article></div>'), ('<section>', '</section>'), ('<div>', '</div>'), ('', '')]


def page(r: random.Random) -> list[tuple[str, int]]:
    word = lambda: "".join(r.choice("bdfglmnprstvz") + r.choice("aeiouäé") for _ in range(r.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    prose = lambda a, b: " ".join(words(3, 14).capitalize() + r.choice(".....,!?") for _ in range(r.randint(a, b)))
    link = lambda: f'<a href="/{word()}">{words(1, 3)}</a>'
    links = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(r.randint(2, 8))) + "</ul>" if r.random() < 0.7 else " ".join(link() for _ in range(r.randint(2, 8)))
    brief = r.random() < 0.35  # an article of very short paragraphs
    small = lambda: r.choice([words(2, 12), prose(1, 2), prose(2, 7), f"<p>{prose(2, 6)}</p>", f"<p>{prose(1, 3)}</p>", f"<h3>{words(1, 4)}</h3><p>{prose(1, 2)}</p>", f"<p>{words(2, 6)}</p>{links()}"])

    def paragraph():
        kind = r.random()
        if kind < 0.72:
            body = prose(1, 6) if not brief or r.random() < 0.2 else r.choice([words(1, 3), words(1, 2).capitalize() + ".", prose(1, 1)])
            if r.random() < 0.2:
                body += f" <b>{words(1, 4)}</b> {link()} <em>{word()}</em> {prose(1, 1)}"
            return r.choice([f"<p>{body}</p>", f"<p>{body}</p>", f"<p>{body}", f"<p><b>{body}<br>", f"<div>{body}</div>"])
        if kind < 0.82:
            return f"<h{r.randint(2, 4)}>{words(2, 7)}</h2>"
        if kind < 0.88:
            return "<ul>" + "".join(f"<li>{words(2, 12)}</li>" for _ in range(r.randint(2, 5))) + "</ul>"
        if kind < 0.92:
            return f"<blockquote><p>{prose(1, 2)}</p></blockquote>"
        if kind < 0.95:
            return f"<pre>{words(3, 20)}</pre>"
        if kind < 0.97:
            return f"<figure><figcaption>{words(3, 9)}</figcaption></figure>"
        return "<table>" + "".join(f"<tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr>" for _ in range(3)) + "</table>"

    out: list[tuple[str, int]] = []
    put = lambda layouts, body: out.append((r.choice(layouts).format(body), 0))
    for layouts, body, chance in ((HEADERS, lambda: r.choice([words(1, 4), f"<h1>{words(1, 3)}</h1>", f"<div>{words(1, 3)}</div>{links()}"]), 0.4), (MENUS, links, 0.9), (NOTICES, small, 0.35), (ADVERTS, small, 0.5), (FORMS, lambda: f"<label>{words(1, 3)}</label><input><button>{word()}</button>", 0.25), (SIDES, small, 0.25)):
        if r.random() < chance:
            put(layouts, body())
    head, tail = r.choice(BODIES if r.random() < 0.85 else BODIES[:3])
    inner: list[tuple[str, int]] = [(f"<h1>{words(3, 9)}</h1>", 1)] if r.random() < 0.85 else []
    if r.random() < 0.15:
        inner = [(f"<header>{inner[0][0] if inner else words(2, 6)}</header>", 1)]
    for _ in range(r.randint(2, 14)):
        inner.append((paragraph(), 1))
        if r.random() < 0.05:
            inner.append((r.choice(ADVERTS + NOTICES + SIDES).format(small()), 0))
    if r.random() < 0.15:
        inner.append((r.choice(COMMENTS).format("".join(f"<p>{prose(1, 3)}</p>" for _ in range(r.randint(1, 4)))), 0))
    out += [(head, 0), *inner, (tail, 0)]
    for layouts, body, chance in ((COMMENTS, lambda: "".join(f"<div>{small()}</div>" for _ in range(r.randint(1, 4))), 0.35), (SIDES, small, 0.35), (FORMS, small, 0.15), (ADVERTS, small, 0.2), (FOOTERS, lambda: r.choice([words(2, 10), f"<p>&copy; {words(2, 6)}</p>", links()]), 0.9)):
        if r.random() < chance:
            put(layouts, body())
    return out


def pages(n: int, seed: int) -> list[list[tuple[str, int]]]:
    r = random.Random(seed)
    return [page(r) for _ in range(n)]
