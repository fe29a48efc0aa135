"""Labelled training pages for the block labeller.

Texts of sampled pages are set into generated layouts: regions of known kinds
in varied order, element names and class names, among them names that say
nothing, so that the labeller has to use texts and neighbours too. Text of the
main region starts with ``MARK``, which reading takes off again as the label.
"""

from __future__ import annotations

from html import escape

import numpy as np

from slotwise.llm.html_blocks import Block, Element, Paths, read

MARK = ""

# Names that page authors give the regions, as "tag class words" or "class words" of a div or section.
ARTICLE = """article; article post; article entry hentry; main; main content; main#main; div article body; div post content; div entry content;
div story; div story body; div#content; div main content; section article text; div article; div page content; div text; section post; div blog post;
div td post content; div single; div rich text; div prose; div itemprop articleBody; div news text""".replace("\n", " ").split("; ")
MENU = """nav; nav navbar; div menu; ul menu; div navigation; div nav bar; ul breadcrumbs; div breadcrumb; nav pagination; div pager; div tags; div toc;
div share; div social; ul nav; div topbar; div skip links; div language; div categories; div related links""".replace("\n", " ").split("; ")
HEADER = """header; header site header; div header; div#header; div masthead; div top; div branding; header banner; div logo; div page header""".replace("\n", " ").split("; ")
FOOTER = """footer; footer site footer; div footer; div#footer; div copyright; div colophon; div bottom; footer legal; div site info; div imprint""".replace("\n", " ").split("; ")
SIDEBAR = """aside; aside sidebar; div sidebar; div#sidebar; div rail; div widget; aside widget area; div right column; div secondary; div related;
div recommended; div popular; div trending; div more stories; section read next; div author bio; div promo box""".replace("\n", " ").split("; ")
ADVERT = """div ad; div ads; div advert; div advertisement; div banner; div sponsored; div promo; aside ad slot; div adsbygoogle; div promoted;
ins ad; div commercial; section sponsor; div partner""".replace("\n", " ").split("; ")
NOTICE = """div notice; div cookie; div cookie banner; div consent; div gdpr; div alert; div warning; div popup; div modal; div overlay; section privacy;
div paywall; noscript; div message; div announcement; div disclaimer; dialog""".replace("\n", " ").split("; ")
FORM = """form; form search; form newsletter; div newsletter; div subscribe; div signup; div login; form contact; div search box; div poll; fieldset""".replace("\n", " ").split("; ")
COMMENTS = """section comments; div comments; div#comments; div comment list; ol comment list; div discussion; div replies; div responses; section#respond;
div reader comments; div disqus thread; div reviews; div feedback; ul comments; section discussion""".replace("\n", " ").split("; ")
WRAPPERS = """div; div wrapper; div container; div row; div col; section; div inner; div#page; div layout; div grid; div site""".replace("\n", " ").split("; ")
# What such regions say, in the languages of the pages.
SAID = {
    "notice": "We use cookies to improve your experience|This site uses cookies. Accept all|Please enable JavaScript to view this page|Wir verwenden Cookies|"
              "Ce site utilise des cookies|Utilizamos cookies|Notice: the service is down on Sunday|Subscribe to continue reading|Your browser is out of date",
    "form": "Subscribe to our newsletter|Enter your email|Search|Send|Sign up|Log in|Name|E-mail|Your message|Password|Submit|Suche|Absenden|Rechercher|Buscar|Enviar",
    "menu": "Home|About|Contact|News|Sport|Politics|Archive|Next|Previous|Share|Tweet|Print|Startseite|Kontakt|Accueil|Inicio|Tags|More|Login|Help|FAQ",
    "footer": "© 2024 All rights reserved|Privacy policy|Terms of use|Imprint|Impressum|Mentions légales|Powered by|Contact us|Follow us|Alle Rechte vorbehalten",
    "comments": "Comments|3 comments|Reply|Leave a reply|Log in to comment|Report|Kommentare|Antworten|Commentaires|Comentarios|posted 2 hours ago|Like",
    "sidebar": "Related articles|Most read|Popular posts|About the author|Recent comments|Read more|You may also like|Trending|Mehr zum Thema|Lire aussi|Archives",
    "advert": "Advertisement|Sponsored|Ad|Anzeige|Publicité|Publicidad|Buy now|Shop the sale|Promoted content",
    "header": "Skip to content|The daily news|Menu|Open menu|Welcome",
}
SAID = {k: v.split("|") for k, v in SAID.items()}
NAMES = {"menu": MENU, "header": HEADER, "footer": FOOTER, "sidebar": SIDEBAR, "advert": ADVERT, "notice": NOTICE, "form": FORM, "comments": COMMENTS}
NEVER = frozenset("nav aside footer form header noscript dialog fieldset".split())
AVOIDED = frozenset("ad ads advert advertisement sponsored promo menu nav sidebar comment comments footer cookie newsletter".split())


def own_label(b: Block) -> int | None:
    """What a page's own markup says of a block: 1 main text, 0 not, None where the page marks no main region."""
    e: Element | None = b.element
    main, other = False, False
    while e is not None and e.parent is not None:
        if not main and (e.tag in NEVER or AVOIDED & set(e.words)):
            other = True
        main = main or e.tag in ("article", "main") or "articlebody" in e.words
        e = e.parent
    return int(main and not other)


class Layouts:
    """Draws pages; ``texts`` are block texts of the sample."""

    def __init__(self, texts: list[str], rng):
        self.rng = rng
        self.words = [w for t in texts for w in t.split()] or "so the of and to in it was is that".split()
        self.prose = [t for t in texts if len(t.split()) >= 6]

    def one(self, options):
        return options[int(self.rng.integers(len(options)))]

    def odds(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def some(self, lo: int, hi: int) -> str:
        """Consecutive words of the sample."""
        n = int(self.rng.integers(lo, hi + 1))
        at = int(self.rng.integers(max(1, len(self.words) - n)))
        return " ".join(self.words[at : at + n])

    def passage(self) -> str:
        if self.prose and self.odds(0.5):
            t = self.one(self.prose).split()
            return " ".join(t[: int(self.rng.integers(5, 160))])
        return self.some(1, 6) if self.odds(0.15) else self.some(5, 90)

    def element(self, options, inner: str, plain: float = 0.12) -> str:
        """``inner`` in an element of one of the named kinds, sometimes of a name that says nothing."""
        name = self.one(options)
        if self.odds(plain):
            name = self.one(("div", "section", "div " + self.some(1, 1).lower(), f"div c{self.rng.integers(99)}"))
        tag, _, words = name.partition(" ")
        if "#" in tag:
            tag, words = tag.split("#")[0], "#" + tag.split("#")[1]
        if words.startswith("#"):
            attributes = f' id="{escape(words[1:])}"'
        elif words.startswith("itemprop"):
            attributes = ' itemprop="articleBody"'
        elif words:
            joint = self.one(("-", "_", " ", "__"))
            attributes = f' class="{escape(joint.join(words.split()))}"'
        else:
            attributes = ""
        return f"<{tag}{attributes}>{inner}</{tag}>"

    def links(self, lo: int, hi: int, kind: str) -> str:
        n = int(self.rng.integers(lo, hi + 1))
        said = [escape(self.one(SAID[kind]) if self.odds(0.4) else self.some(1, 4)) for _ in range(n)]
        if self.odds(0.7):
            return "<ul>" + "".join(f'<li><a href="#">{s}</a></li>' for s in said) + "</ul>"
        return self.one((" | ", " ", "<br>")).join(f'<a href="#">{s}</a>' for s in said)

    def region(self, kind: str) -> str:
        """A region that is not main text."""
        said = lambda: escape(self.one(SAID[kind]) if self.odds(0.5) else self.some(2, 25))
        if kind == "menu":
            inner = self.links(2, 9, "menu")
        elif kind == "header":
            inner = f"<{self.one(('h1', 'p', 'div', 'span'))}>{said()}" + (self.element(MENU, self.links(2, 7, "menu")) if self.odds(0.5) else "")
        elif kind == "footer":
            inner = f"<p>&copy; {escape(self.some(1, 3))} &middot; {said()}</p>" if self.odds(0.5) else said() + self.links(1, 5, "footer")
        elif kind == "sidebar":
            inner = f"<h3>{said()}</h3>" + (self.links(2, 6, "sidebar") if self.odds(0.6) else f"<p>{escape(self.passage())}</p>")
        elif kind == "advert":
            inner = said() if self.odds(0.6) else f"<p>{escape(self.passage())}</p>"
        elif kind == "form":
            inner = "".join(f"<{t}>{said()}</{t}>" for t in [self.one(("label", "p", "button", "legend", "h3")) for _ in range(int(self.rng.integers(1, 4)))])
        elif kind == "comments":
            tag = self.one(("article class='comment'", "div class='comment'", "li", "div", "p", "blockquote"))
            each = [f"<{tag}>" + (f"<b>{escape(self.some(1, 2))}</b> " if self.odds(0.5) else "") + f"<p>{escape(self.passage())}</p>" +
                    (f"<a href='#'>{said()}</a>" if self.odds(0.4) else "") + f"</{tag.split()[0]}>" for _ in range(int(self.rng.integers(1, 7)))]
            inner = (f"<h3>{escape(self.one(SAID[kind]))}</h3>" if self.odds(0.6) else "") + "".join(each)
        else:
            inner = f"<p>{said()}</p>" + (f"<button>{escape(self.some(1, 2))}</button>" if self.odds(0.4) else "")
        return self.element(NAMES[kind], inner)

    def main(self) -> str:
        """The article, with what is set into it."""
        say = lambda t: MARK + escape(t)
        parts = [f"<h1>{say(self.some(2, 12))}</h1>"] if self.odds(0.8) else []
        for _ in range(int(self.rng.integers(1, 6)) if self.odds(0.4) else int(self.rng.integers(4, 26))):
            text, draw = self.passage(), self.rng.random()
            if draw < 0.72:
                body = say(text)
                if self.odds(0.15):
                    body = f"{self.one(('<b>', '<em>', '<a href=#>', '<span>'))}{body}"
                    body += "" if self.odds(0.3) else "</b></em></a></span>"
                parts.append(f"<p>{body}" + ("" if self.odds(0.1) else "</p>"))
            elif draw < 0.8:
                parts.append(f"<h2>{say(self.some(1, 7))}</h2>")
            elif draw < 0.87:
                parts.append("<ul>" + "".join(f"<li>{say(self.some(1, 18))}</li>" for _ in range(int(self.rng.integers(2, 6)))) + "</ul>")
            elif draw < 0.91:
                parts.append(f"<blockquote><p>{say(text)}</p></blockquote>")
            elif draw < 0.94:
                parts.append(f"<pre>{say(text)}</pre>")
            elif draw < 0.97:
                parts.append("<table>" + "".join(f"<tr><td>{say(self.some(1, 3))}</td><td>{say(self.some(1, 4))}</td></tr>" for _ in range(3)) + "</table>")
            else:
                parts.append(f"<figure><img src=x><figcaption>{say(self.some(2, 12))}</figcaption></figure>")
        for kind, p in (("advert", 0.3), ("sidebar", 0.15), ("menu", 0.2), ("form", 0.15), ("notice", 0.1), ("footer", 0.08)):
            if self.odds(p):
                parts.insert(int(self.rng.integers(1, len(parts) + 1)), self.region(kind))
        if self.odds(0.12):
            parts.append(self.region("comments"))
        return self.element(ARTICLE, "".join(parts), 0.08)

    def page(self) -> str:
        drawn = lambda kinds: [self.region(k) for k, p in kinds if self.odds(p)]
        before = drawn((("notice", 0.25), ("header", 0.5), ("menu", 0.7), ("notice", 0.1), ("advert", 0.4), ("sidebar", 0.15), ("menu", 0.15), ("form", 0.15)))
        after = drawn((("menu", 0.15), ("comments", 0.4), ("sidebar", 0.3), ("advert", 0.25), ("form", 0.25), ("footer", 0.75), ("notice", 0.2)))
        middle = [self.main()]
        if self.odds(0.3):
            middle = [self.element(WRAPPERS, "".join([*drawn((("sidebar", 0.4),)), *middle, *drawn((("sidebar", 0.4), ("comments", 0.3), ("advert", 0.3)))]), 0)]
        body = "".join([*before, *middle, *after])
        if self.odds(0.4):
            body = self.element(WRAPPERS, body, 0)
        return f"<html><body>{body}</body></html>"


def marked(html: str, paths: Paths) -> tuple[list[Block], np.ndarray]:
    """Blocks of a generated page and their labels."""
    blocks = read(html, paths)
    labels = np.array([MARK in b.text for b in blocks], np.float32)
    for b in blocks:
        b.text = b.text.replace(MARK, "")
    kept = [bool(b.text.strip()) for b in blocks]
    return [b for b, k in zip(blocks, kept, strict=True) if k], labels[np.array(kept, bool)]
