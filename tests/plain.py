"""Plain Python versions of what queries without SQL return, one row at a time."""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict
from datetime import datetime, timedelta
from difflib import SequenceMatcher
from html.parser import HTMLParser
from urllib.parse import urljoin


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def history_keys(history: list[dict], events: list[dict]) -> dict[int, str]:
    """seq -> key. Every event tries every row of the history in the order of its file, then the rows of this run."""
    first = lambda r: r["event_start_date"] or (r["event_dates"] or "").split("|")[0]
    ordered = sorted(history, key=lambda r: (r["event_start_date"] or r["event_dates"] or "9999-99-99", r["company"] or "", r["artist"] or "", r["event_key"]))
    rows = {r["event_key"]: (r["artist_id"], r["activity_type"], first(r), (r["event_name"] or "").lower(), r["approval_status"] == "MANUAL_CONFIRMED") for r in ordered}
    out = {}
    for e in sorted(events, key=lambda e: e["seq"]):
        start, name, to = str(e["event_start_date"] or ""), (e["event_name"] or e["title"]).lower(), e["event_key"]
        if to not in rows:
            for key, (artist, kind, day, known, _) in rows.items():
                if (artist, kind) == (e["artist_id"], e["activity_type"]):
                    alike = ratio(known, name)
                    if alike >= 0.72 or (day and day == start and alike >= 0.25):
                        to = key
                        break
        if to not in rows or not rows[to][4]:
            rows[to] = (e["artist_id"], e["activity_type"], start or str((e["event_dates"] or [""])[0]), name, False)
        out[e["seq"]] = to
    return out


def clusters(articles: list[dict]) -> dict[int, int]:
    """seq -> seq of the first member: each article tries every member of every cluster, in order of quality."""
    blocks = defaultdict(list)
    for a in articles:
        blocks[a["artist_id"], a["activity_type"]].append(a)
    out = {}
    for block in blocks.values():
        found: list[list[dict]] = []
        for a in sorted(block, key=lambda a: (-a["score"], -a["published_at"].timestamp(), a["seq"])):
            home = next((c for c in found if any(_same(a, m) for m in c)), None)
            if home is None:
                found.append([a])
            else:
                home.append(a)
            out[a["seq"]] = (home or found[-1])[0]["seq"]
    return out


def _same(a: dict, b: dict) -> bool:
    """Both are dated by one day here: the same day and like names or words."""
    if a["event_start_date"] != b["event_start_date"]:
        return False
    anchors = [re.sub(r"[^0-9a-z]", "", x["event_name"].lower()) for x in (a, b)]
    if anchors[0] and anchors[0] == anchors[1]:
        return True
    words = [{w for w in re.findall(r"[0-9a-z]+", f"{x['title']} {x['event_name']}".lower()) if len(w) >= 2} for x in (a, b)]
    shared = len(words[0] & words[1]) / len(words[0] | words[1]) if words[0] | words[1] else 0.0
    return max(shared, ratio(anchors[1], anchors[0]) if all(anchors) else 0.0) >= 0.48


def schedule(new: list[dict], old: list[dict]) -> dict[int, tuple]:
    """seq -> schedule_status, activity_type, score, number of known events, for concerts of one day and one city each."""
    squeeze = lambda t: re.sub(r"[^0-9a-z가-힣]", "", t.lower())
    by_artist = defaultdict(list)
    for o in old:
        by_artist[o["artist_id"]].append(o)
    out = {}
    for e in new:
        met = [o for o in by_artist[e["artist_id"]] if ratio(squeeze(o["event_name"]), squeeze(e["event_name"])) >= 0.48]
        days, cities = {o["event_dates"] for o in met}, {o["cities"] for o in met}
        if not met:
            said = ("NEW_EVENT", "CONCERT", 0)
        elif e["cities"][0] not in cities:
            said = ("NEW_CITY", "TOUR_EXPANSION", 12)
        elif str(e["event_start_date"]) not in days:
            said = ("SAME_CITY_NEW_DATE", "ADDITIONAL_SHOW", 15)
        else:
            said = ("EXISTING_SCHEDULE", "CONCERT", 0)
        out[e["seq"]] = (said[0], said[1], e["score"] + said[2], len(met))
    return out


def _space(text: str) -> str:
    return " ".join(text.split())


class _Tree(HTMLParser):
    """A tree of [tag, attributes, children]; what is open at the end is closed there."""

    void = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = ["", {}, []]
        self.path = [self.root]

    def handle_starttag(self, tag, attrs):
        node = [tag, dict(attrs), []]
        self.path[-1][2].append(node)
        if tag not in self.void:
            self.path.append(node)

    def handle_startendtag(self, tag, attrs):
        self.path[-1][2].append([tag, dict(attrs), []])

    def handle_endtag(self, tag):
        for i in range(len(self.path) - 1, 0, -1):
            if self.path[i][0] == tag:
                del self.path[i:]
                return

    def handle_data(self, data):
        self.path[-1][2].append(data)


def page(source: str) -> list:
    tree = _Tree()
    tree.feed(source or "")
    tree.close()
    return tree.root


def walk(node):
    yield node
    for child in node[2]:
        if isinstance(child, list):
            yield from walk(child)


def texts(node, silent=("script", "style", "noscript", "template")) -> list[str]:
    out = []
    for child in node[2]:
        if isinstance(child, str):
            out.append(child)
        elif child[0] not in silent:
            out += texts(child, silent)
    return out


def title(source: str) -> str:
    nodes = list(walk(page(source)))
    declared = [n[1].get("content") or "" for n in nodes if n[0] == "meta" and n[1].get("property") == "og:title"]
    headings = [" ".join(texts(n)) for n in nodes if n[0] == "h1"]
    titles = ["".join(texts(n)) for n in nodes if n[0] == "title"]
    return next((t for t in map(_space, [*declared[:1], *headings[:1], *titles[:1]]) if t), "")


def listed(source: str, url: str, least: int = 2) -> list[tuple[str, str]]:
    """Address and text of the first link of each list item, each address once."""
    seen, out = set(), []
    for node in walk(page(source)):
        if node[0] in ("article", "li") or {"post", "item"} & set((node[1].get("class") or "").split()):
            links = [n for n in walk(node) if n[0] == "a" and n[1].get("href")]
            if links:
                to, said = urljoin(url or "", html.unescape(links[0][1]["href"])), _space(" ".join(texts(links[0])))
                if len(said) >= least and to not in seen:
                    seen.add(to)
                    out.append((to, said))
    return out


def selected(source: str, url: str, least: int = 2) -> list[tuple[int, str, str, str]]:
    """place, address, title and text of the first link in every li, then in every paragraph that is a child of the body, then in every paragraph inside a div and every nav."""
    root = page(source)

    def below(node, path):
        for child in node[2]:
            if isinstance(child, list):
                yield child, path + [node]
                yield from below(child, path + [node])

    nodes = list(below(root, []))
    chosen = [n for n, _ in nodes if n[0] == "li"] + [n for n, path in nodes if n[0] == "p" and path[-1][0] == "body"]
    chosen += [n for n, path in nodes if n[0] == "nav" or (n[0] == "p" and any(a[0] == "div" for a in path))]
    said = lambda n: " ".join(t for t in map(_space, texts(n, ("script", "style", "template"))) if t)
    seen, out = set(), []
    for node in chosen:
        link = next((n for n in walk(node) if n is not node and n[0] == "a" and "href" in n[1]), None)
        if link is not None:
            to, title = urljoin(url or "", html.unescape(link[1]["href"] or "")), said(link) or said(node)
            if to and len(title) >= least and to not in seen:
                seen.add(to)
                out.append((len(seen), to, title, said(node)))
    return out


def fold_decisions(items: list[dict], history: list[dict], queue: list[dict], key) -> tuple[dict, list[str]]:
    """event_key -> event_name and the candidates left, one decision after the other; key: of a row."""
    rows, waiting = {r["event_key"]: dict(r) for r in history}, {r["candidate_id"]: dict(r) for r in queue}
    fields = {"eventName": "event_name", "activityType": "activity_type", "eventStartDate": "event_start_date", "artist": "artist", "artistId": "artist_id"}
    for d in items:
        action = d["action"].upper()
        if action in ("APPROVE", "REJECT"):
            source = waiting.pop(d["candidateId"])
        elif action in ("UPDATE", "DELETE"):
            source = rows.pop(d["eventKey"])
        else:
            source = {}
        if action in ("APPROVE", "UPDATE", "CREATE"):
            made = source | {fields[k]: v for k, v in d.items() if k in fields}
            rows[key(made)] = made
    return {k: r["event_name"] for k, r in rows.items()}, sorted(waiting)


def daily(orders: list[dict], first, last) -> list[tuple]:
    """seq, artist_id, event_key, start, articles of the run over titles made of orders: each says its customer, a concert, and its day or span of three days; published 20 days before."""
    blocks = defaultdict(list)
    for o in orders:
        day = o["o_orderdate"].date()
        published = datetime.combine(day - timedelta(days=20), datetime.min.time())
        if first <= published <= last:
            end = day + timedelta(days=2 if o["o_orderkey"] % 3 == 0 else 0)
            words = {f"{d.month}월" for d in (day, end)} | {f"{d.day}일" for d in (day, end)}
            blocks[o["o_custkey"]].append((-published.timestamp(), o["o_orderkey"], day, end, words))
    out = []
    for customer, articles in blocks.items():
        found: list[list[tuple]] = []
        for a in sorted(articles, key=lambda a: a[:2]):
            same = lambda m, a=a: a[2] <= m[3] and m[2] <= a[3] and len(a[4] & m[4]) >= 0.48 * len(a[4] | m[4])
            home = next((c for c in found if any(map(same, c))), None)
            if home is None:
                found.append([a])
            else:
                home.append(a)
        for c in found:
            _, _, start, end, _ = min(c, key=lambda a: a[1])  # of equally good dates those of the first article
            key = hashlib.sha256(f"{customer}|CONCERT|customer{customer:09d}콘서트|{start}:{end}|".encode()).hexdigest()[:24]
            out.append((c[0][1], str(customer), key, str(start), len(c)))
    return sorted(out)
