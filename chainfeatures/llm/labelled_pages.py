"""Labelled pages to train the page model on, composed by rule from a seed.

A page is a list of parts around one article; every part has the tags, class words and
the kind of text that sites use for it.  ``y="1"`` marks the article, ``y="0"`` what
does not belong to it, also inside the article.
"""

from __future__ import annotations

import random

# --- fixed values: how sites mark the parts of a page ---
BOILER = {
    "menu": [("nav", ""), ("nav", "main-nav"), ("div", "menu"), ("ul", "navbar"), ("div", "breadcrumbs"), ("div", "toolbar"), ("div", "navigation")],
    "header": [("header", ""), ("header", "site-header"), ("div", "header"), ("div", "masthead"), ("div", "top-bar")],
    "footer": [("footer", ""), ("footer", "site-footer"), ("div", "footer"), ("div", "copyright"), ("div", "legal")],
    "sidebar": [("aside", ""), ("aside", "sidebar"), ("div", "sidebar"), ("div", "widget"), ("div", "related"), ("section", "recommended")],
    "notice": [("div", "cookie-banner"), ("div", "notice"), ("div", "consent"), ("div", "popup"), ("div", "newsletter"), ("div", "alert"), ("div", "modal")],
    "advert": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "sponsored"), ("div", "promo"), ("aside", "ad-slot"), ("div", "banner")],
    "form": [("form", ""), ("form", "search"), ("div", "login"), ("form", "subscribe"), ("form", "contact")],
    "share": [("div", "share"), ("ul", "social"), ("div", "tags"), ("div", "share-buttons")],
    "comments": [("section", "comments"), ("div", "comment-list"), ("div", "comments"), ("ol", "commentlist"), ("div", "discussion"), ("div", "replies")],
}
ARTICLE = [("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article-body"), ("div", "entry-content"), ("section", "story"),
           ("div", "post-text"), ("div", "text"), ("div", "main-text")]
# --- end of fixed values ---


def _text(r: random.Random, n: int, stops: bool = True) -> str:
    out = []
    for _ in range(n):
        w = "".join(r.choice("aeiourtnslkmd") for _ in range(r.randint(2, 9)))
        out.append(w + ("." if stops and r.random() < 0.1 else ""))
    return " ".join(out).capitalize() + ("." if stops and r.random() < 0.8 else "")


def _link(r, n=2):
    return f'<a href="/x">{_text(r, r.randint(1, n), False)}</a>'


def _boiler(r: random.Random, kind: str) -> str:
    tag, cls = r.choice(BOILER[kind])
    attr = f' {r.choice(["class", "id"])}="{cls}"' if cls else ""
    if kind in ("menu", "share"):
        items = "".join(f"<li>{_link(r)}</li>" for _ in range(r.randint(2, 8)))
        body = items if tag in ("ul", "ol") else f"<ul>{items}</ul>" if r.random() < 0.7 else " ".join(_link(r) for _ in range(r.randint(2, 6)))
    elif kind == "header":
        body = f"<div>{_text(r, 3, False)}</div>" + (f"<ul><li>{_link(r)}</li><li>{_link(r)}</li></ul>" if r.random() < 0.5 else "")
    elif kind == "footer":
        body = r.choice([f"&copy; {_text(r, 3)} {_text(r, r.randint(3, 14))}", f"<p>{_text(r, r.randint(4, 14))}</p>", f"<ul><li>{_link(r)}</li></ul><p>&copy; {_text(r, 4)}</p>"])
    elif kind == "sidebar":
        body = f"<h3>{_text(r, 3, False)}</h3>" + r.choice(["<ul>" + "".join(f"<li>{_link(r, 6)}</li>" for _ in range(4)) + "</ul>", f"<p>{_text(r, r.randint(6, 30))}</p>"])
    elif kind == "form":
        body = f"<label>{_text(r, 2, False)}</label><input type=text><button>{_text(r, 1, False)}</button>" + (f"<p>{_text(r, 9)}</p>" if r.random() < 0.4 else "")
    elif kind == "comments":
        one = lambda: f'<{"li" if tag == "ol" else "div"} class="comment"><b>{_text(r, 1, False)}</b><p>{_text(r, r.randint(4, 50))}</p></{"li" if tag == "ol" else "div"}>'
        body = "".join(one() for _ in range(r.randint(1, 4)))
    else:
        body = r.choice([_text(r, r.randint(4, 25)), f"<p>{_text(r, r.randint(4, 25))}</p>", f"<p>{_text(r, 5)} {_link(r)}</p>"])
    return f'<{tag}{attr} y="0">{body}</{tag}>'


def _article(r: random.Random) -> str:
    tag, cls = r.choice(ARTICLE)
    attr = f' {r.choice(["class", "id"])}="{cls}"' if cls else ""
    head = f"<h1>{_text(r, r.randint(2, 9), False)}</h1>" if r.random() < 0.8 else ""
    parts = []
    for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9])):
        k = r.random()
        if k < 0.68:
            parts.append(f"<p>{_text(r, r.choice([1, 2, 4, 12, 30, 60, 90, 300, 1200]), r.random() < 0.8)}{' ' + _link(r) + ' ' + _text(r, 6) if r.random() < 0.15 else ''}</p>")
        elif k < 0.76:
            parts.append(f"<h2>{_text(r, r.randint(1, 5), False)}</h2>")
        elif k < 0.86:
            parts.append("<ul>" + "".join(f"<li>{_text(r, r.randint(1, 15))}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
        elif k < 0.91:
            parts.append(f"<blockquote><p>{_text(r, r.randint(5, 30))}</p></blockquote>")
        elif k < 0.95:
            parts.append(f"<table><tr><td>{_text(r, 2)}</td><td>{_text(r, 2)}</td></tr></table>")
        elif k < 0.97:
            parts.append(f"<pre>{_text(r, 10)}</pre>")
        else:
            parts.append(f"<div>{_text(r, r.randint(8, 40))}</div>")
    for kind in ("advert", "share", "sidebar", "comments", "form", "notice", "header"):
        if r.random() < 0.12:
            parts.insert(len(parts) if kind in ("share", "comments", "form") else r.randint(0, len(parts)), _boiler(r, kind))
    return f'<{tag}{attr} y="1">{head}{"".join(parts)}</{tag}>'


def labelled_pages(n: int = 500, seed: int = 3) -> list[str]:
    r = random.Random(seed)
    pages = []
    for _ in range(n):
        before = [_boiler(r, k) for k in ("notice", "header", "menu", "advert", "form") if r.random() < 0.45]
        after = [_boiler(r, k) for k in ("share", "sidebar", "comments", "advert", "form", "menu", "footer") if r.random() < 0.4]
        body = "".join(before) + _article(r) + "".join(after)
        for _ in range(r.randint(0, 2)):
            body = f'<div{r.choice(["", " class=wrapper", " id=page", " class=container"])}>{body}</div>'
        pages.append(f"<html><head><title>{_text(r, 4)}</title></head><body>{body}</body></html>")
    return pages
