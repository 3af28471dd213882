"""Page parsing by scans of the whole stack: slow on broken markup, but plain."""

import html
import re

from reachlens.llm.html_text import BLOCK, BORDERS, ENDS, HEADINGS, LEFT_OUT, RAW, TOKEN, VOID, Node, _signs


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str, int]]]:
    """Elements in page order, and text blocks (element, text, characters of link text)."""
    root = Node("html", None, False, False)
    nodes, blocks, stack = [root], [], [root]
    run: list[str] = []
    inside_links = 0
    link_run = 0

    def close_block() -> None:
        nonlocal link_run
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                holder = next(n for n in reversed(stack) if n.tag in BLOCK)
                blocks.append((holder, text, min(link_run, len(text))))
            run.clear()
        link_run = 0

    def text_at(text: str) -> None:
        nonlocal link_run
        run.append(text)
        if inside_links:
            link_run += len(" ".join(html.unescape(text).split()))

    def pop_to(depth: int) -> None:
        nonlocal inside_links
        while len(stack) > depth:
            if stack.pop().tag == "a":
                inside_links -= 1

    at = 0
    while True:
        m = TOKEN.search(page, at)
        if m is None:
            if at < len(page):
                text_at(page[at:])
            break
        if m.start() > at:
            text_at(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if tag in BLOCK:
            close_block()
        if m[1] or m[4]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth:
                if tag in BLOCK or not any(n.tag in BLOCK for n in stack[depth:]):
                    pop_to(depth)
            elif tag == "p":
                close_block()
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag in ("html", "body") and any(n.tag == tag for n in stack):
            continue
        if tag in BLOCK:
            for i in range(len(stack) - 1, 0, -1):  # a paragraph ends where another block begins
                if stack[i].tag == "p" or (stack[i].tag in HEADINGS and tag in HEADINGS):
                    pop_to(i)
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in ENDS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ENDS[tag]:
                    pop_to(i)
                    if tag != "tr" or stack[-1].tag not in ENDS[tag]:
                        break
                elif stack[i].tag in BORDERS:
                    break
        elif tag == "a" and inside_links:
            i = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "a")
            if not any(n.tag in BLOCK for n in stack[i:]):
                pop_to(i)
        parent = stack[-1]
        attributes = m[3] or m[6] or ""
        out, good, doubt, named = _signs(tag, attributes) if attributes.strip(" /") else (False, False, False, False)
        if tag == "header" and any(n.tag in ("article", "main") for n in stack):
            pass  # its headings are the article's
        elif tag == "form":
            doubt, named = True, False
        elif tag in LEFT_OUT:
            out = True
        node = Node(tag, parent, out, good, doubt, named)
        nodes.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not attributes.endswith("/") or (tag in BLOCK and tag not in VOID):
            stack.append(node)
            if tag == "a":
                inside_links += 1
                for n in stack:
                    n.links += 1
    close_block()
    return nodes, blocks
