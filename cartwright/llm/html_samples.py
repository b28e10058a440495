"""A small labelled table: hand-labelled page layouts for the block classifier.

Blocks whose tag carries ``data-article`` belong to the article, all others do
not. The layouts are our own; words are filler, what counts is structure.
"""

from __future__ import annotations

from collections.abc import Iterator

_FILL = "river stone under early light moves along quiet paths while people carry water home before noon and talk".split()


def _words(n: int, at: int = 0) -> str:
    return " ".join(_FILL[(at + 3 * i) % len(_FILL)] for i in range(n)).capitalize() + "."


def _p(*sizes: int, tag: str = "p") -> str:
    return "".join(f"<{tag} data-article>{_words(n, i)}</{tag}>" for i, n in enumerate(sizes))


def _linked(n: int, words: int = 1) -> str:
    return "".join(f'<li><a href="/{i}">{_words(words, i)[:-1]}</a></li>' for i in range(n))


def _menu(n: int = 6) -> str:
    return f"<nav><ul>{_linked(n)}</ul></nav>"


def _title(n: int = 6) -> str:
    return f"<h1 data-article>{_words(n)[:-1]}</h1>"


def pages() -> Iterator[str]:
    foot = f"<footer>&copy; site &middot; {_words(8)}</footer>"
    # article element: paragraphs of every length belong to it, down to a word
    for sizes in ((60, 1, 40, 3, 90), (1, 2), (5, 80, 12, 30), (200, 150, 1, 1, 8), (1,), (3, 4, 2), (25, 35, 45)):
        yield f'<body>{_menu()}<div class="ad">{_words(7)}</div><article>{_title()}{_p(*sizes)}</article>{foot}</body>'
        yield (f"<body><header><a href='/'>Home</a><p>{_words(9)}</p></header>{_menu(4)}<main>{_title(4)}{_p(*sizes)}"
               f"<aside><p>{_words(20)}</p></aside>{_p(30, 2)}</main><aside><h3>{_words(3)}</h3><ul>{_linked(8, 4)}</ul>"
               f"</aside>{foot}</body>")
    # lists, quotes, tables and links inside an article
    yield (f"<body>{_menu()}<article>{_title(9)}{_p(40, 6)}<ul>{_p(4, 12, 1, tag='li')}</ul><blockquote data-article>"
           f"{_words(15)}</blockquote><table><tr>{_p(1, 2, 3, tag='td')}</tr></table><h2 data-article>{_words(3)[:-1]}</h2>"
           f"<p data-article>{_words(5)} <a href='/x'>{_words(4)}</a></p><p data-article><a href='/y'>{_words(6)}</a></p>"
           f"</article>{foot}</body>")
    # wrappers whose class names a layout, and a form around the page
    for start, end in (("<div class='layout no-sidebar'>", "</div>"), ("<form action='/'>", "</form>")):
        yield (f"<body>{start}{_menu()}<article>{_title()}{_p(50, 3, 20)}</article><div class='comments'><article><p>{_words(40)}"
               f"</p></article></div>{foot}{end}</body>")
    # adverts, forms, notices and comments, some inside the article
    for long in (5, 45, 120):
        yield (f'<body><div id="cookie-notice"><p>{_words(long)}</p></div>{_menu(9)}<article>{_title()}{_p(50, 4)}'
               f'<div class="advert"><p>{_words(long)}</p></div>{_p(70)}<form><p>{_words(6)}</p></form>{_p(1, 33)}'
               f'<div class="share"><p>{_words(3)}</p></div></article><section id="comments"><h2>{_words(2)}</h2>'
               f'<article><p>{_words(long)}</p></article><article><p>{_words(2 * long)}</p></article></section>{foot}</body>')
        yield (f'<body><div class="site-header"><p>{_words(long)}</p></div><div class="menu"><ul>{_linked(7, 2)}</ul></div>'
               f'<div class="article-body">{_title(7)}{_p(20, 2, 60, 1)}</div><div class="sidebar"><p>{_words(long)}</p>'
               f'<ul>{_linked(5, 6)}</ul></div><div class="comments"><p>{_words(long)}</p><p>{_words(30)}</p></div>'
               f'<div class="footer"><p>{_words(10)}</p></div></body>')
    # pages that name nothing: text and links of the blocks and their neighbours decide
    for sizes in ((60, 45, 80), (30, 6, 55, 8, 40), (90, 20, 35, 35), (120, 5, 70)):
        yield (f"<body><div>{''.join(f'<p><a href={i}>{_words(2)[:-1]}</a></p>' for i in range(5))}</div><div>{_title(7)}"
               f"{_p(*sizes)}</div><div><p><a href='/a'>{_words(3)}</a> <a href='/b'>{_words(4)}</a></p>"
               f"<p><a href='/c'>{_words(8)}</a></p><p>{_words(3)[:-1]}</p></div></body>")
        yield (f"<body><table><tr><td><ul>{_linked(9, 2)}</ul></td><td>{_p(*sizes)}</td><td><ul>{_linked(6, 5)}</ul></td>"
               f"</tr></table><p>{_words(2)[:-1]} <a href='/t'>{_words(2)}</a></p></body>")
        # lists of linked headlines, and link-heavy boxes, however long
        yield (f"<body><div>{_title(5)}{_p(*sizes)}</div><div>" + "".join(
            f"<p><a href='/{n}'>{_words(n)}</a> {_words(k)}</p>" for n, k in ((14, 2), (22, 5), (18, 1), (30, 9), (16, 3)))
            + "</div></body>")
        yield (f"<body><ul>{_linked(6, 16)}</ul><div>{_p(*sizes)}</div><ul>{_linked(4, 25)}</ul><p>{_words(4)[:-1]}</p></body>")
    # an article without a name beside named boxes, however long their text
    for long in (8, 30, 60, 150):
        for sizes in ((60, 45, 80), (120, 12, 70)):
            boxes = ("<div class='comments'><p>", "<footer><p>", "<div class='cookie-notice'><p>", "<div class='ad'><p>", "<form><p>",
                     "<aside><p>", "<div class='related'><p>", "<section id='newsletter'><p>")
            yield (f"<body>{_menu()}<div>{_title(6)}{_p(*sizes)}</div>"
                   + "".join(f"{box}{_words(long + i)} {_words(long, i)}</p></{box[1:].split('>')[0].split()[0]}>"
                             for i, box in enumerate(boxes)) + "</body>")
            yield (f"<body><div class='cookie-notice'><p>{_words(long)}</p></div><div>{_title(5)}{_p(*sizes)}</div>"
                   f"<div class='comments'><p>{_words(long)}</p><p>{_words(2 * long)}</p></div><footer><p>{_words(long)}</p></footer></body>")
    # an article element, and long text around it that has no name
    for long in (15, 40, 90):
        yield (f"<body><div><p>{_words(long)}</p></div><article>{_title()}{_p(long, 3, 60)}</article>"
               f"<div><p>{_words(2 * long)}</p><p>{_words(long)}</p></div></body>")
    yield f"<p data-article>{_words(50)}</p>"
    yield f"<p data-article>{_words(12)}</p><p data-article>{_words(40)}</p>"
    yield f"<body>{_menu(10)}<ul>{_linked(20, 6)}</ul>{foot}</body>"
