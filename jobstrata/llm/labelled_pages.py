"""Labelled pages to train the page model on, made by a rule.

Layouts differ in the elements and names that hold the article and in the boilerplate around and inside it. Boxes that
belong to the article carry ``data-label="1"``, others ``data-label="0"``; text takes the label of the nearest box. The
names are those that public style sheets commonly use.
"""

from __future__ import annotations

import random

ARTICLE = ["article", "main", "article class='post'", "div id='content'", "div class='article-body'", "main id='main'",
           "section class='story'", "div class='post-content entry'", "td class='main-text'", "div class='text'",
           "article class='news-item'", "div itemprop='articleBody' class='body-text'", "div role='main'"]
NOT_ARTICLE = {
    "links": ["nav", "nav class='menu'", "div class='navbar'", "div id='nav' class='navigation'", "ul class='menu main-menu'",
              "div class='breadcrumb breadcrumbs'", "div class='pagination pager'", "div class='related-posts related'",
              "div class='tags categories'", "aside class='sidebar'", "div id='sidebar'", "div class='widget'",
              "div class='share social'", "footer", "footer id='footer'", "header class='site-header top'", "header",
              "menu", "div class='toc links'", "div role='navigation'", "div class='recommended more trending'"],
    "prose": ["div class='ad'", "div class='ads advert'", "div class='advertisement banner'", "aside", "aside class='promo'",
              "div class='sponsored sponsor'", "div class='cookie-notice'", "div id='cookie-consent' class='cookies gdpr'",
              "div class='notice alert'", "div class='popup modal overlay'", "div class='newsletter subscribe signup'",
              "footer", "footer class='legal copyright disclaimer'", "div class='sidebar'", "header", "div role='alert'",
              "div class='site-info'", "dialog", "div class='paywall login'", "div role='contentinfo'"],
    "comments": ["div class='comments'", "section id='comments' class='comment-list'", "div class='comment reply'",
                 "ol class='commentlist discussion'", "div class='reader-comments responses'", "section class='feedback'", "div id='disqus_thread'",
                 "div class='fb-comments' id='discussion'", "div id='respond'", "div id='utterances'", "section id='user-reviews'"],
    "form": ["form", "form class='search'", "form id='contact'", "form class='newsletter'"],
}
_WORDS = ("the of and to a in is it that for with as was on are by be this have from or had not but what all were when we "
          "there can an your which their said if do will each about how up out them then she many some so these would "
          "river stone market letter winter engine garden paper window captain bread silver music doctor harbour").split()


class _Maker:
    def __init__(self, seed: int):
        self.dice = random.Random(seed)

    def sentence(self, low: int = 5, high: int = 18) -> str:
        words = [self.dice.choice(_WORDS) for _ in range(self.dice.randint(low, high))]
        return " ".join(words).capitalize() + self.dice.choice([".", ".", ".", "!", "?"])

    def prose(self, low: int = 1, high: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.dice.randint(low, high)))

    def notice(self, high: int = 3) -> str:
        """What stands in boilerplate: mostly short, sometimes as long as a paragraph of an article or longer."""
        return self.prose(1, high) if self.dice.random() < 0.6 else self.prose(3, 20)

    def phrase(self) -> str:
        return " ".join(self.dice.choice(_WORDS) for _ in range(self.dice.randint(1, 4))).capitalize()

    def heading(self) -> str:
        name = self.dice.choice(["h2", "h3", "h4"])
        return f"<{name}>{self.phrase()}</{name}>"

    def box(self, opening: str, label: int, inner: str) -> str:
        return f"<{opening} data-label='{label}'>{inner}</{opening.split()[0]}>"

    def links(self) -> str:
        items = [f"<a href='/x'>{self.phrase()}</a>" for _ in range(self.dice.randint(2, 8))]
        return self.dice.choice([f"<ul>{''.join(f'<li>{i}</li>' for i in items)}</ul>", " ".join(items),
                                 f"<p>{' | '.join(items)}</p>"])

    def paragraphs(self) -> str:
        out = []
        for _ in range(self.dice.randint(1, 9)):
            kind = self.dice.random()
            if kind < 0.7:
                out.append(f"<p>{self.prose(1, 6) if self.dice.random() < 0.8 else self.prose(4, 20)}</p>")
            elif kind < 0.78:
                out.append(self.heading())
            elif kind < 0.84:
                out.append(f"<ul>{''.join(f'<li>{self.sentence(1, 9)}</li>' for _ in range(3))}</ul>")
            elif kind < 0.89:
                out.append(f"<blockquote><p>{self.prose(1, 2)}</p></blockquote>")
            elif kind < 0.93:
                out.append(f"<p>{self.phrase()}</p>")
            elif kind < 0.96:
                out.append(f"<p><a href='/y'>{self.phrase()}</a></p>")
            else:
                out.append(f"<table><tr><td>{self.phrase()}</td><td>{self.phrase()}</td></tr></table>")
        return "".join(out)

    def boilerplate(self) -> str:
        kind = self.dice.choice(["links", "links", "prose", "prose", "comments", "form"])
        opening = self.dice.choice(NOT_ARTICLE[kind])
        if kind == "links":
            inner = self.links()
        elif kind == "prose":
            inner = self.dice.choice([self.notice(), f"<p>{self.notice()}</p>", f"{self.heading()}<p>{self.notice(2)}</p>"])
        elif kind == "comments":
            name = self.dice.choice([" class='comment'", " class='comment'", " class='post-body'", ""])
            one = [f"<div{name}><p>{self.notice(4)}</p></div>" for _ in range(self.dice.randint(1, 5))]
            inner = self.dice.choice([self.heading(), ""]) + "".join(one)
        else:
            inner = f"<p>{self.phrase()}</p><label>{self.phrase()}</label><select><option>{self.phrase()}</select><button>{self.phrase()}</button>"
        return self.box(opening, 0, inner)

    def page(self) -> str:
        before = "".join(self.boilerplate() for _ in range(self.dice.randint(0, 4)))
        after = "".join(self.boilerplate() for _ in range(self.dice.randint(0, 4)))
        title = f"<h1>{self.phrase()}</h1>"
        inside = self.paragraphs()
        if self.dice.random() < 0.3:
            cut = self.dice.choice([k + 4 for k in range(len(inside)) if inside.startswith("</p>", k)] or [len(inside)])
            inside = inside[:cut] + self.boilerplate() + inside[cut:]
        bare = self.dice.random()  # pages without any box: all of it is the article
        if bare < 0.05:
            return self.dice.choice([self.phrase(), self.prose()])
        if bare < 0.15:
            return f"<html><body>{self.paragraphs()}</body></html>" if bare < 0.1 else self.paragraphs()
        article = self.box(self.dice.choice(ARTICLE), 1, title + inside)
        body = before + article + after
        if self.dice.random() < 0.4:
            body = f"<div class='{self.dice.choice(['wrapper', 'container', 'page', 'row'])}'>{body}</div>"
        return f"<html><head data-label='0'><title>{self.phrase()}</title></head><body data-label='0'>{body}</body></html>"


def pages(n: int = 600, seed: int = 7) -> list[str]:
    maker = _Maker(seed)
    return [maker.page() for _ in range(n)]
