"""Labelled pages for the node classifier, drawn from a small grammar of page layouts.

Words of the article carry ``MARK``; a node is content if its subtree holds a mark.  Layouts
vary what sites vary: semantic or plain elements, naming attributes or none, wrappers,
order of the parts, what stands inside or next to the article, unclosed and cut-off markup.
"""

from __future__ import annotations

import random

from .dom import MARK

SYLLABLES = ("ta re mi on el ka su ver lin do par que zen ist ung ment eau ción ñe ou th er and the of in to a is it "
             "wh st ble ing der die und le la des y en").split()
NAMES = {  # naming attributes that sites give to the parts of a page
    "article": "article post post-content entry-content story articleBody content main-content news-item body-text blog-post",
    "nav": "nav navbar main-menu menu site-navigation breadcrumb pagination tabs topnav menu-list",
    "ad": "ad ads advert ad-slot sponsored promo-box banner-ad advertisement google-ad",
    "comments": "comments comment-list reader-comments disqus_thread responses comments-area discussion",
    "footer": "footer site-footer foot colophon copyright page-footer legal",
    "header": "header masthead site-header top-bar branding logo page-header",
    "sidebar": "sidebar aside widget-area related related-posts rail widget popular-posts secondary",
    "notice": "cookie-notice cookie-banner notice gdpr-consent alert popup modal-box privacy-notice message",
    "share": "share social-links sharing post-meta byline share-buttons tags toolbar",
    "form": "newsletter login-form search-form subscribe contact-form signup"}
ELEMENTS = {"article": "article main div section div", "nav": "nav nav div ul", "ad": "div div aside section p",
            "comments": "section div div ol", "footer": "footer footer div", "header": "header header div",
            "sidebar": "aside div section", "notice": "div div section aside", "share": "div ul p", "form": "form form div"}
WRAPPERS = ("wrapper", "container", "page", "site", "row", "col-8", "inner", "layout", "", "", "grid", "app")


class Page:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.named = self.rng.random() < 0.8      # the site names its parts
        self.semantic = self.rng.random() < 0.75  # the site uses semantic elements

    # -- text
    def word(self) -> str:
        return "".join(self.rng.choice(SYLLABLES) for _ in range(self.rng.choice((1, 1, 2, 2, 3))))

    def words(self, n: int, mark: str = "", separator: str = " ") -> str:
        out = [self.word() for _ in range(max(n, 1))]
        out[0] = out[0].capitalize()
        out = [mark + w + self.rng.choice(("", "", "", "", "", ",", ".")) for w in out]
        return separator.join(out)

    def sentence(self, mark: str = "") -> str:
        return self.words(self.rng.randint(3, 18), mark) + "."

    def link(self, mark: str = "", n: int | None = None) -> str:
        return f'<a href="/{self.word()}">{self.words(n or self.rng.randint(1, 3), mark)}</a>'

    # -- parts
    def open(self, kind: str) -> tuple[str, str]:
        rng = self.rng
        tag = rng.choice(ELEMENTS[kind].split()) if self.semantic else ("form" if kind == "form" else "div")
        # a part of the page that is neither a semantic element nor a list of links has a name on every site
        plain = kind != "article" and tag in ("div", "p", "section", "ol")
        has_name = plain or self.named and rng.random() < 0.85
        name = ""
        if has_name:
            name = f' {rng.choice(("class", "class", "id"))}="{rng.choice(NAMES[kind].split())}"'
        return f"<{tag}{name}>", f"</{tag}>"

    def part(self, kind: str, inside: str) -> str:
        a, b = self.open(kind)
        return a + inside + b

    def paragraph(self, mark: str = "") -> str:
        rng, n = self.rng, self.rng.choice((1, 1, 2, 3, 4, 6))
        parts = [self.sentence(mark) for _ in range(n)]
        if rng.random() < 0.15:
            parts = [self.words(rng.randint(1, 4), mark)]
        if rng.random() < 0.15:
            parts = [self.words(rng.randint(3, 30), mark, rng.choice((" | ", "!! ", " $$$ ", " ")))]
        if rng.random() < 0.15:
            parts.insert(rng.randrange(len(parts) + 1), self.link(mark))
        text = " ".join(parts)
        if rng.random() < 0.15:
            text = f"<b>{text}" + ("</b>" if rng.random() < 0.5 else "<br>")
        return f"<p>{text}" + ("</p>" if rng.random() < 0.9 else "")

    def article(self, bare: bool = False) -> str:
        rng, m = self.rng, MARK
        out = []
        if rng.random() < 0.85:
            title = f"<h1>{self.words(rng.randint(1, 12), m)}</h1>"
            out.append(f"<header>{title}</header>" if rng.random() < 0.1 else title)
        if rng.random() < 0.2:
            out.append(self.part("share", self.words(3) + self.link()))
        for _ in range(rng.choice((1, 2, 3, 5, 8, 13, 25))):
            r = rng.random()
            if r < 0.78:
                out.append(self.paragraph(m))
            elif r < 0.84:
                out.append(f"<h{rng.choice((2, 3))}>{self.words(rng.randint(1, 6), m)}</h2>")
            elif r < 0.9:
                tag = rng.choice(("ul", "ol"))
                out.append(f"<{tag}>" + "".join(
                    f"<li>{self.link(m) if rng.random() < 0.2 else self.sentence(m)}</li>"
                    for _ in range(rng.randint(2, 6))) + f"</{tag}>")
            elif r < 0.93:
                out.append(f"<blockquote>{self.paragraph(m)}</blockquote>")
            elif r < 0.95:
                out.append(f"<pre><code>{self.words(8, m)}</code></pre>")
            elif r < 0.97:
                out.append("<table>" + "".join(
                    "<tr>" + "".join(f"<td>{self.words(2, m)}</td>" for _ in range(3)) + "</tr>" for _ in range(3))
                    + "</table>")
            else:
                out.append(f'<figure><img src="x.jpg"><figcaption>{self.sentence(m)}</figcaption></figure>')
            if rng.random() < 0.05:
                out.append(self.ad())
            if rng.random() < 0.02:
                out.append(self.form())
        if rng.random() < 0.15:
            out.append(self.part("share", "".join(self.link() for _ in range(3))))
        if rng.random() < 0.12:
            out.append(self.part("sidebar", self.links()))
        if rng.random() < 0.08:
            out.append(self.comments())
        body = "".join(out)
        if rng.random() < 0.2:
            body = f"<div>{body}</div>"
        return body if bare else self.part("article", body)

    def links(self) -> str:
        rng = self.rng
        items = [self.link() for _ in range(rng.randint(2, 9))]
        if rng.random() < 0.75:
            text = "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        else:
            text = rng.choice((" ", " | ", " &middot; ")).join(items)
        return (f"<h3>{self.words(2)}</h3>" if rng.random() < 0.2 else "") + text

    def nav(self) -> str:
        return self.part("nav", self.links())

    def ad(self) -> str:
        rng = self.rng
        text = " ".join(self.sentence() for _ in range(rng.choice((1, 1, 2, 3))))
        return self.part("ad", rng.choice((text, f"<p>{text}</p>", text + self.link())))

    def form(self) -> str:
        rng = self.rng
        return self.part("form", f"<p>{self.sentence()}</p><label>{self.words(2)}</label><input type=text>"
                         + (f"<button>{self.words(1)}</button>" if rng.random() < 0.7 else ""))

    def comments(self) -> str:
        rng = self.rng
        one = rng.choice(('<div class="comment">', "<li>", '<div class="reply">', "<article>", "<div>"))
        end = f"</{one[1:].split()[0].rstrip('>')}>"
        return self.part("comments", f"<h3>{self.words(2)}</h3>" + "".join(
            one + (f'<span class="author">{self.word()}</span> ' if rng.random() < 0.5 else "")
            + f"<p>{' '.join(self.sentence() for _ in range(rng.randint(1, 4)))}</p>" + end
            for _ in range(rng.randint(1, 8))))

    def footer(self) -> str:
        rng = self.rng
        text = rng.choice(("&copy; ", "&copy; 2024 ", "Copyright ", "")) + self.word() + ".example.com"
        text += rng.choice((" &middot; ", " - ", " ")) + " ".join(self.sentence() for _ in range(rng.choice((1, 1, 2, 3))))
        return self.part("footer", rng.choice((text, f"<p>{text}</p>", text + self.links(), f"<p>{text}</p>" + self.nav())))

    def header(self) -> str:
        rng = self.rng
        return self.part("header", rng.choice((f"<h2>{self.words(2)}</h2>", self.link(), f"<p>{self.sentence()}</p>"))
                         + (self.nav() if rng.random() < 0.4 else ""))

    def notice(self) -> str:
        return self.part("notice", f"<p>{self.sentence()}</p>" + ("<button>OK</button>" if self.rng.random() < 0.5 else ""))

    def sidebar(self) -> str:
        rng = self.rng
        return self.part("sidebar", f"<h3>{self.words(2)}</h3>" + rng.choice(
            (self.links(), f"<p>{self.sentence()}</p>", self.links() + self.ad())))

    def wrap(self, inside: str) -> str:
        name = self.rng.choice(WRAPPERS)
        return f'<div class="{name}">{inside}</div>' if name else f"<div>{inside}</div>"

    def html(self) -> str:
        rng = self.rng

        def maybe(p: float, make) -> str:
            return make() if rng.random() < p else ""

        before = [maybe(0.35, self.header), maybe(0.75, self.nav), maybe(0.3, self.notice), maybe(0.45, self.ad)]
        if rng.random() < 0.3:
            rng.shuffle(before)
        middle = maybe(0.12, self.sidebar) + self.article(bare=rng.random() < 0.08)
        middle += maybe(0.25, self.comments) + maybe(0.25, self.sidebar) + maybe(0.15, self.form)
        if rng.random() < 0.5:
            middle = self.wrap(middle)
        if rng.random() < 0.15 and self.semantic:
            middle = f"<main>{middle}</main>"
        if rng.random() < 0.05:  # a page that is nothing but its article
            return self.article(bare=True)
        body = "".join(before) + middle + maybe(0.2, self.ad) + maybe(0.85, self.footer) + maybe(0.1, self.notice)
        for _ in range(rng.choice((0, 0, 1, 2))):
            body = self.wrap(body)
        page = f"<!DOCTYPE html><html><head><title>{self.words(5)}</title></head><body>{body}</body></html>"
        return page[:rng.randrange(len(page) // 2, len(page))] if rng.random() < 0.1 else page
