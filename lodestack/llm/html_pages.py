"""Labelled pages to train the block labeller on: pages of many layouts whose article is known by construction."""

from __future__ import annotations

import random

# Names that layouts commonly give to parts of a page.
MENU_NAMES = ["nav", "menu", "navbar", "navigation", "topnav", "breadcrumb", "breadcrumbs", "pagination", "toc", "tabs", "links", "site-nav", "main-menu", "skip"]
HEADER_NAMES = ["header", "masthead", "topbar", "site-header", "branding", "logo", "top", "page-header"]
FOOTER_NAMES = ["footer", "copyright", "site-footer", "bottom", "legal", "colophon", "credits", "disclaimer"]
SIDE_NAMES = ["sidebar", "aside", "widget", "related", "recommended", "popular", "trending", "tags", "author-box", "right-column", "rail", "more", "secondary", "complementary"]
NOTICE_NAMES = ["cookie", "cookie-notice", "consent", "notice", "alert", "gdpr", "popup", "modal", "overlay", "message", "privacy", "warning", "toast"]
AD_NAMES = ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "banner", "promotion", "adbox", "ad-slot", "affiliate", "adsense"]
FORM_NAMES = ["newsletter", "subscribe", "signup", "login", "search", "contact", "form", "social", "share", "sharing"]
COMMENT_NAMES = ["comments", "comment", "comment-list", "respond", "reply", "discussion", "comment-body", "disqus", "reader-comments", "replies", "responses", "feedback"]
ARTICLE_NAMES = ["content", "post", "entry", "entry-content", "article", "article-body", "story", "main", "main-content", "post-body", "text", "body", "page"]
POST_NAV_NAMES = ["post-navigation", "entry-navigation", "nav-links", "post-nav", "article-nav", "prev-next", "pager"]
POST_FOOTER_NAMES = ["entry-footer", "post-footer", "article-footer", "entry-meta", "post-meta", "post-tags", "tag-list"]
FILED_TEXTS = ["Tagged", "Tags", "Filed under", "Posted in", "Categories", "Category", "Topics", "Labels", "Share this", "Permalink"]
RIGHTS = "All rights reserved"
SHORT_TEXTS = ["Home", "About us", "Contact", "Next", "Previous", "Read more", "Log in", "Sign up", "Share", "Menu", "Privacy", "Terms", "Search", "Subscribe", "Reply", "Archive"]


class PageMaker:
    """Makes pages as lists of (html, label of its blocks); labels are 1 for the article."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.syllables = [a + b for a in "b c d f g h j k l m n p r s t v w z".split() for b in "a e i o u é ö ü an er in on".split()]

    def words(self, low: int, high: int) -> str:
        text = " ".join("".join(self.r.choices(self.syllables, k=self.r.randint(1, 4))) for _ in range(self.r.randint(low, high)))
        return text[:1].upper() + text[1:]

    def sentences(self, n: int) -> str:
        return " ".join(self.words(4, 16) + self.r.choice([".", ".", ".", "!", "?"]) for _ in range(n))

    def short(self) -> str:
        return self.r.choice([self.r.choice(SHORT_TEXTS), self.words(1, 3)])

    def link(self) -> str:
        return f'<a href="/{self.r.random()}">{self.short()}</a>'

    def named(self, tag: str, names: list[str]) -> str:
        kind = self.r.choice(["class", "id", "class"])
        return f'<{tag} {kind}="{self.r.choice(names)}">'

    def part(self, tags: list[str], names: list[str], inner: str, label: int = 0, bare: float = 0.0) -> tuple[str, int]:
        tag = self.r.choice(tags)
        begin = f"<{tag}>" if self.r.random() < bare and tag not in ("div", "section") else self.named(tag, names)
        return f"{begin}{inner}</{tag}>", label

    def menu(self):
        if self.r.random() < 0.15:
            return self.unlinked_menu()
        items = "".join(f"<li>{self.link()}</li>" for _ in range(self.r.randint(3, 9)))
        inner = self.r.choice([f"<ul>{items}</ul>", " ".join(self.link() for _ in range(self.r.randint(2, 6))), f"<ol>{items}</ol>"])
        return self.part(["nav", "nav", "div", "ul" if inner[:3] == "<li" else "div"], MENU_NAMES, inner, bare=0.5)

    def unlinked_menu(self):
        """A menu of plain words, as scripts make them; often nothing names it."""
        items = [self.r.choice(SHORT_TEXTS) for _ in range(self.r.randint(2, 7))]
        tag = self.r.choice(["ul", "ul", "ul", "ol"])
        listed = f"<{tag}>" + "".join(f"<li>{x}</li>" for x in items) + f"</{tag}>"
        return self.r.choice([(listed, 0), (listed, 0), (f"<nav>{listed}</nav>", 0), self.part(["nav", "div"], MENU_NAMES, listed, bare=0.3)])

    def article_nav(self):
        """Links to other articles, within or after an article."""
        inner = self.r.choice([" ".join(self.link() for _ in range(self.r.randint(1, 3))), f"<ul><li>{self.link()}</li><li>{self.link()}</li></ul>", f"<div>{self.link()}</div><div>{self.link()}</div>", self.short()])
        return self.part(["nav", "nav", "div"], [*MENU_NAMES, *POST_NAV_NAMES, *POST_NAV_NAMES], inner, bare=0.4)

    def article_header(self):
        inner = self.r.choice([f"<p>{self.words(1, 5)}</p>", self.link(), f"{self.words(1, 3)} {self.link()}"])
        return self.part(["header", "div"], HEADER_NAMES, inner)

    def article_footer(self):
        """Where an article was filed, and what may follow it."""
        text = self.r.choice([f"{self.r.choice(FILED_TEXTS)} {self.link()}", f"{self.r.choice(FILED_TEXTS)}: {self.link()}, {self.link()}", f"{self.r.choice(FILED_TEXTS)} {self.words(1, 4)}", self.link(), self.last_words()])
        return self.part(["footer", "footer", "div"], [*FOOTER_NAMES, *POST_FOOTER_NAMES, *POST_FOOTER_NAMES], self.r.choice([text, f"<p>{text}</p>", f"<ul><li>{text}</li></ul>"]), bare=0.4)

    def buttons(self):
        one = lambda: f"<button{self.r.choice(['', ' type=button', ' class=share'])}>{self.short()}</button>"
        inner = "".join(one() for _ in range(self.r.randint(1, 3)))
        return self.r.choice([inner, inner, f"<div>{inner}</div>", f"<p>{inner}</p>"]), 0

    def last_words(self) -> str:
        """What stands below a page, in words or with its sign."""
        owner = self.r.choice([self.words(1, 4), f"{self.words(1, 3)} {self.link()}"])
        year = self.r.choice([f"{self.r.randint(1996, 2026)} ", ""])
        rights = self.r.choice(["", f" {RIGHTS}.", f" {RIGHTS}", f". {RIGHTS}."])
        return self.r.choice([f"&copy; {year}{owner}{rights}", f"Copyright {year}{owner}{rights}", f"Copyright &copy; {year}{owner}{rights}", f"{year}{owner}. {RIGHTS}."])

    def header(self):
        inner = self.r.choice([f"<h1>{self.words(1, 4)}</h1>", f"<p>{self.words(2, 9)}</p>", self.link(), f"<div>{self.words(1, 4)}</div><p>{self.sentences(1)}</p>"])
        return self.part(["header", "div"], HEADER_NAMES, inner, bare=0.5)

    def footer(self):
        text = self.r.choice([f"&copy; {self.words(1, 3)} &middot; {self.sentences(self.r.randint(1, 3))}", self.last_words(), self.sentences(2), f"{self.link()} {self.link()}"])
        return self.part(["footer", "footer", "div"], FOOTER_NAMES, self.r.choice([text, f"<p>{text}</p>"]), bare=0.6)

    def side(self):
        inner = self.r.choice([f"<h3>{self.words(1, 4)}</h3><ul>" + "".join(f"<li>{self.link()}</li>" for _ in range(4)) + "</ul>", f"<p>{self.sentences(self.r.randint(1, 4))}</p>", f"<h2>{self.words(1, 3)}</h2><p>{self.sentences(2)}</p>", self.sentences(2)])
        return self.part(["aside", "aside", "div", "section"], SIDE_NAMES, inner, bare=0.5)

    def notice(self):
        text = self.sentences(self.r.randint(1, 4))
        return self.part(["div", "div", "section", "aside", "p", "dialog"], NOTICE_NAMES, self.r.choice([text, f"<p>{text}</p>", f"<p>{text}</p><button>{self.short()}</button>"]) if self.r.random() < 0.9 else self.link())

    def advert(self):
        text = self.sentences(self.r.randint(1, 4))
        return self.part(["div", "div", "div", "section", "aside", "p"], AD_NAMES, self.r.choice([text, text, f"<p>{text}</p>", self.link()]))

    def form(self):
        inner = f"<label>{self.words(1, 4)}</label><input name=q><p>{self.sentences(1)}</p><button>{self.short()}</button>"
        if self.r.random() < 0.7:
            return f"<form action=/x>{inner}</form>", 0
        return self.part(["div", "section"], FORM_NAMES, inner)

    def comments(self):
        each = lambda: self.r.choice([f"<p>{self.sentences(self.r.randint(1, 5))}</p>", f"<div><b>{self.words(1, 2)}</b> {self.sentences(2)}</div>", f"<h4>{self.words(1, 2)}</h4><p>{self.sentences(3)}</p>", f"<header><h1>{self.words(1, 2)}</h1></header><p>{self.sentences(4)}</p>"])
        inner = self.r.choice(["<h2>Comments</h2>", f"<h3>{self.words(1, 3)}</h3>", "", ""])
        # one kind of element for all comments of a page, often such as articles have
        begin, end = self.r.choice([('<div class="comment">', "</div>"), ("<li>", "</li>"), ("", ""), ('<article class="comment">', "</article>"), ("<article>", "</article>"), ("<article>", "</article>"), ("<article><div>", "</div></article>"), ("<section>", "</section>"), ('<div class="comment-body"><article>', "</article></div>")])
        inner += "".join(begin + each() + end for _ in range(self.r.choice([1, 1, 1, 2, 3, 5])))
        return self.part(["section", "div", "div", "ol", "ul", "aside"], COMMENT_NAMES, inner)

    def paragraph(self) -> str:
        text = self.sentences(self.r.choice([1, 1, 2, 3, 5, 8]))
        if self.r.random() < 0.25:
            text = self.words(1, 6) + self.r.choice([".", "", ":"])
        if self.r.random() < 0.2:
            text = text.replace(" ", f" <a href=x>{self.words(1, 2)}</a> ", 1)
        table = f"<table><tr><th>{self.words(1, 2)}</th><td>{self.words(1, 5)}</td></tr></table>"
        items = "".join(f"<li>{self.words(2, 12)}</li>" for _ in range(self.r.randint(2, 5)))
        return self.r.choice([f"<p>{text}</p>"] * 12 + [f"<p><b>{text}<br>"] * 3 + [f"<p>{text}"] * 2 + [f"<h2>{self.words(1, 8)}</h2>", f"<ul>{items}</ul>", f"<ol>{items}</ol>", f"<blockquote>{text}</blockquote>", f"<pre>{text}</pre>", table, f"<div>{text}</div>", f"<figure><figcaption>{self.words(3, 9)}</figcaption></figure>", f"<dl><dt>{self.words(1, 2)}</dt><dd>{text}</dd></dl>"])

    def article(self) -> list[tuple[str, int]]:
        title = f"<h1>{self.words(2, 12)}</h1>"
        if self.r.random() < 0.25:
            title = f"<header>{title}<p>{self.words(2, 5)}</p></header>"
        body = [(title, 1)] if self.r.random() < 0.85 else []
        body += [(self.paragraph(), 1) for _ in range(self.r.choice([0, 1, 2, 4, 8, 14]))]
        if not body:
            body = [(self.paragraph(), 1)]
        for _ in range(self.r.choice([0, 0, 0, 1, 2])):
            body.insert(self.r.randint(1, len(body)), self.r.choice([self.advert, self.notice, self.form, self.side, self.comments, self.buttons])())
        for made, chance in ((self.article_nav, 0.12), (self.article_footer, 0.15), (self.buttons, 0.08), (self.unlinked_menu, 0.03)):
            if self.r.random() < chance:
                body.append(made())
        if self.r.random() < 0.08:
            body.insert(0, self.r.choice([self.article_nav, self.article_header])())
        begin, end = self.r.choice([("<article>", "</article>")] * 4 + [("<main>", "</main>"), ("<main><article>", "</article></main>"), ("", "")] + [(self.named(t, ARTICLE_NAMES), f"</{t}>") for t in ("div", "div", "div", "section", "article")])
        if self.r.random() < 0.25:
            # an outer part that holds more than the article, at times in a part of its own
            beside = [self.r.choice([self.article_nav, self.article_nav, self.side, self.menu, self.article_footer, self.comments])()] if self.r.random() < 0.5 else []
            outer = [self.named(self.r.choice(["div", "div", "main", "section"]), ARTICLE_NAMES) for _ in range(self.r.choice([1, 1, 2]))]
            close = "".join(f"</{x[1:].split()[0]}>" for x in reversed(outer))
            return [("".join(outer) + begin, -1), *body, (end, -1), *beside, (close, -1)]
        return [(begin, -1), *body, (end, -1)]

    def sectioned(self) -> list[tuple[str, int]]:
        """A page whose parts have names or section elements."""
        before = [f() for f in (self.notice, self.header, self.menu, self.advert, self.side, self.form) if self.r.random() < 0.4]
        after = [f() for f in (self.side, self.comments, self.comments, self.form, self.advert, self.notice, self.menu, self.footer) if self.r.random() < 0.4]
        self.r.shuffle(before)
        return [*before, *self.article(), *after]

    def prose(self) -> list[tuple[str, int]]:
        """An article of a heading and paragraphs, where no name tells it from the rest."""
        body = [(f"<h{self.r.randint(1, 3)}>{self.words(2, 10)}</h{self.r.randint(1, 3)}>", 1)] if self.r.random() < 0.8 else []
        texts = [self.sentences(self.r.randint(1, 8)) for _ in range(self.r.randint(1, 10))]
        return body + [(self.r.choice([f"<p>{x}</p>"] * 4 + [f"<div>{x}</div>", f"<blockquote>{x}</blockquote>", f"<div><p>{x}</p></div>"]), 1) for x in texts]

    def row_of_links(self) -> str:
        return self.r.choice([" | ", " ", "</p><p>", "<br>"]).join(self.link() for _ in range(self.r.randint(1, 8)))

    def plain(self) -> list[tuple[str, int]]:
        """A page of nothing but div, p and headings: rows of links and a last line around the article."""
        wrap = lambda x, label: (self.r.choice(["<div>{}</div>", "<div><p>{}</p></div>", "<p>{}</p>", "<div><div>{}</div></div>"]).format(x), label)
        before = [wrap(self.row_of_links(), 0) for _ in range(self.r.choice([0, 1, 1, 2]))]
        after = [wrap(self.row_of_links(), 0) for _ in range(self.r.choice([0, 0, 1, 2]))]
        if self.r.random() < 0.25:
            before.append(self.unlinked_menu())
        if self.r.random() < 0.6:
            after.append(wrap(self.last_words(), 0))
        depth = self.r.choice([0, 1, 1, 2])
        return [*before, ("<div>" * depth, -1), *self.prose(), ("</div>" * depth, -1), *after]

    def tabled(self) -> list[tuple[str, int]]:
        """A page laid out as a table: links in a row above or a cell beside, the article in another cell."""
        attributes = self.r.choice(["", " width=100%", ' border="0" cellpadding="0"'])
        links, side = (f"<td>{self.row_of_links()}</td>", 0), self.r.random() < 0.7
        rows = [("<table" + attributes + ">", -1)]
        if self.r.random() < 0.5:
            rows += [("<tr>", -1), (f"<td colspan=2>{self.r.choice([self.row_of_links(), self.row_of_links(), self.words(1, 3)])}</td>", 0), ("</tr>", -1)]
        first = self.r.random() < 0.7
        rows += [("<tr>", -1), *([links] if side and first else []), ("<td>", -1), *self.prose(), ("</td>", -1), *([links] if side and not first else []), ("</tr>", -1)]
        if self.r.random() < 0.5:
            rows += [("<tr>", -1), (f"<td colspan=2>{self.last_words()}</td>", 0), ("</tr>", -1)]
        return [*rows, ("</table>", -1)]

    def page(self) -> list[tuple[str, int]]:
        return self.r.choices([self.sectioned, self.plain, self.tabled], [6, 1, 1])[0]()


def labelled_pages(n: int = 1600, seed: int = 5) -> list[tuple[str, list[int]]]:
    """(html, label of each leaf block) of ``n`` pages."""
    from .html_blocks import leaf_blocks

    maker, out = PageMaker(seed), []
    while len(out) < n:
        # a private-use character before each part's text tells its blocks' label, and is taken away again
        html, marked = "<html><head><title>T</title></head><body>", "<html><head><title>T</title></head><body>"
        for part, label in maker.page():
            html += part
            marked += part if label < 0 else _marked(part, "\ue001" if label else "\ue000")
        blocks, tagged = leaf_blocks(html), leaf_blocks(marked)
        labels = [1 if "\ue001" in b.text else 0 for b in tagged if b.text.strip("\ue000\ue001 ")]
        if len(labels) == len(blocks):
            out.append((html, labels))
    return out


def _marked(part: str, mark: str) -> str:
    out, inside = [], False
    for c in part:
        if c == "<":
            inside = True
        elif not inside and not c.isspace() and (not out or out[-1] == ">"):
            out.append(mark)
        out.append(c)
        if c == ">":
            inside = False
    return "".join(out)
