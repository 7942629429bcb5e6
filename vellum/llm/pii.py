"""Problem 9: personal information inside free text.

A semi-Markov conditional random field over whole segments. Patterns propose every
span that could be a name, an e-mail address, a phone, an identity number or a street
address, each with every label it could have. A segment is scored as a whole by the
features of its shape and of what stands around it, and a dynamic programme picks the
best set of segments that do not overlap, boundaries and types together.

What stands around a span is told by classes of words (titles, words for phones, for
papers of identity, for codes, for sums, for firms and courts) and closed lists of
function words, not by the words of any text. The weights are trained here, by gradient
ascent on the likelihood of sentences made up from this module's own patterns and lists
(TRAINED_ON of them, a fixed seed). No sentence, name or place of the corpus is among
them: a test looks for every twelve letters of them in the test tables.
"""

from __future__ import annotations

import random
import re
import unicodedata
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from math import exp, log

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELS = ("person", "email", "phone", "id_number", "address")
PLACEHOLDER = {n: f"[{n.upper()}]" for n in LABELS}
#: Sentences made up for training.
TRAINED_ON = 3000
#: Words of a run of capitalised words up to which every stretch of it may be a name; in a longer run those up to so many words, and every stretch that ends with the run.
RUN = 12

_LATIN_RANGE = [chr(c) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))]
_UP = "A-Z" + "".join(c for c in _LATIN_RANGE if c.isupper())
_LO = "a-z" + "".join(c for c in _LATIN_RANGE if c.islower())
_NAME = rf"(?:[{_UP}][{_LO}]+(?:['’-][{_UP}][{_LO}]+)*|[{_UP}]{{2,}}(?:['’-][{_UP}]+)*|[{_UP}]\.)"
_RUN = re.compile(rf"(?<![{_UP}{_LO}\d@._-]){_NAME}(?:[  ]{_NAME})+(?![{_UP}{_LO}\d@])")
_PART = re.compile(_NAME)
_AT = r"(?:\s?@\s?|\s?[\[({](?:at|a còng|a-còng)[\])}]\s?)"
_EMAIL = re.compile(rf"[A-Za-z0-9][\w.+-]*{_AT}[A-Za-z0-9-]+(?:(?:\.|\s(?:dot|chấm)\s|\s?[\[(](?:dot|chấm)[\])]\s?)[A-Za-z0-9-]+)+", re.IGNORECASE)
_DIGITS = re.compile(r"(?<![\w./,-])(?:\+|\()?\d[\d .()-]{6,22}\d(?![\w/,]\d|\w|/)")
_DOCUMENT = re.compile(r"(?<!\w)[A-Z]\d{7,8}(?!\w)")
_STREETS = "ngõ|ngách|hẻm|kiệt|đường|phố|thôn|ấp|xóm|tổ|khu phố|đại lộ"
_STREETS += "|" + _STREETS.upper()
_AREAS = r"phường|quận|huyện|xã|thị trấn|thành phố|tỉnh|TP\.|thôn|ngõ|ngách|đường|phố"
_AREAS += "|" + _AREAS.upper()
_WAY = "Street|Road|Lane|Avenue|Quay|Hill|Row|Close|Court|Square|Drive|Terrace|Way|Gate|Mews|Place"
_HOUSE = r"(?<![\w./,-])\d{1,4}[A-Za-z]?(?:/\d{1,4}[A-Za-z]?)*"
_CAPS = rf"[{_UP}][\w'’-]*(?:[  ][{_UP}][\w'’-]*)?"
_ADDRESS_VI = re.compile(rf"{_HOUSE},?\s(?:(?:{_STREETS})\s(?:\d+[A-Za-z]?|{_CAPS}))(?:,?\s(?:{_AREAS})\s(?:\d+[A-Za-z]?|{_CAPS}))*")
_ADDRESS_EN = re.compile(rf"{_HOUSE},?\s(?:(?:[{_UP}][\w'’-]+\s){{1,4}}(?:{_WAY}|{_WAY.upper()})|(?:rue|avenue|boulevard|chemin|quai|place|impasse)\s(?:(?:de|du|des|la|le|l')\s?)*{_CAPS})(?:,\s(?:\d{{4,6}}\s)?{_CAPS})?")
_TOKEN = re.compile(r"[^\W\d_]+\.?|\d+|[^\w\s]")

#: The most frequent family names of Vietnam (fixed values).
SURNAMES = frozenset(
    "nguyễn trần lê phạm hoàng huỳnh phan vũ võ đặng bùi đỗ hồ ngô dương lý đào đinh mai trịnh trương lâm phùng tô hà chu châu cao tạ quách "
    "thạch khiếu mạc kiều la lương lưu mã ninh nông ông tăng thái thân tiêu tôn triệu từ văn viên vương đoàn đàm đồng giang khổng khương kim".split()
)
TITLES = frozenset("ông bà anh chị cô chú bác em mr mr. mrs mrs. ms ms. miss dr dr. m. m mme mlle maître witness sư chứng judge professor".split())
#: Titles of two words: the second with the first.
PAIRED = {"sư": "luật", "chứng": "làm"}
STREET_WORDS = frozenset("đường phố ngõ ngách hẻm thôn phường quận huyện xã tỉnh tp. tp trấn vực ấp xóm tuyến đảo sông cầu chợ làng kiệt rue avenue boulevard quai impasse chemin".split())
GROUP_WORDS = frozenset("công ty cổ phần tnhh tòa án vụ tập đoàn ngân hàng doanh nghiệp trường viện see v. vs. company court bank society société cour tribunal ltd inc llc corp freight transport school college university hospital hotel association banque école".split())
#: Last words of names of places.
PLACE_WORDS = frozenset("vale city town port county district village island river bridge park valley bay beach".split())
WAYS = frozenset(_WAY.lower().split("|"))
#: Function words that are told apart beside a span; other words count by their shape.
SMALL = frozenset("là do của và với cho từ tại ở tên gửi bởi về theo by from to with of at and the a for in on de du par chez à au et la le no".split())
#: Words that say what a number nearby is: of phones, papers of identity, codes and accounts, sums and measures.
_KINDS = {
    "phone": "điện thoại|đt|sđt|di động|máy bàn|gọi|hotline|zalo|nhắn|fax|tel|tél|phone|telephone|téléphone|mobile|call|called|appeler|appelez|dial|ring|bấm số|liên lạc",
    "paper": "cccd|cmnd|cmt|căn cước|chứng minh|định danh|hộ chiếu|tùy thân|tuỳ thân|giấy tờ|pièce|passport|identity|id|passeport|identité|cni|thẻ",
    "code": "mã|mã vạch|barcode|code|tài khoản|account|compte|invoice|hóa đơn|vận đơn|đơn hàng|tra cứu|serial|order|reference|facture|iban|isbn|code-barres",
    "sum": "số tiền|trị giá|giá|đồng|vnd|vnđ|usd|euro|euros|eur|dollars|price|worth|sum|montant|km|mét|metres",
}
_KIND = re.compile("|".join(rf"(?P<{k}>(?<!\w)(?:{w})(?!\w))" for k, w in _KINDS.items()))
_SUM_AFTER = re.compile(rf"\s?(?:{_KINDS['sum']})(?!\w)")


def composed(text: str) -> tuple[str, list[int] | None]:
    """The text in composed letters, and for each of its characters the place in the given text; None where nothing changes."""
    if text.isascii() or unicodedata.is_normalized("NFC", text):
        return text, None
    out, place, start = [], [], 0
    for i in range(1, len(text) + 1):
        if i == len(text) or not unicodedata.combining(text[i]):
            part = unicodedata.normalize("NFC", text[start:i])
            out.append(part)
            place += [start] * len(part)
            start = i
    return "".join(out), [*place, len(text)]


def _shape(token: str) -> str:
    """How a token beside a span counts: a function word by itself, others by their kind."""
    if not token or token.lower() in SMALL:
        return token.lower()
    return "number" if token.isdigit() else "capital" if token[0].isupper() else "word" if token[0].isalpha() else token


class Surroundings:
    """What stands before and after places of one text, looked at once for each place."""

    def __init__(self, text: str):
        self.text, self._before, self._after = text, {}, {}

    def before(self, start: int) -> tuple[str, str, bool, list[str], str, int]:
        """Two tokens before, whether a sentence begins, features of these, the kind of number announced, letters of a run of names on the left."""
        if (found := self._before.get(start)) is None:
            text = self.text
            tokens = _TOKEN.findall(text[max(0, start - 40) : start])[-3:]
            b2, b1 = ["", "", *tokens][-2:]
            fresh = not tokens or text[max(0, start - 2) : start].rstrip(" ")[-1:] in ".!?;•*+\n:" or text[start - 1] == "\n"
            window = text[max(0, start - 60) : start].lower()
            kind, near = "none", ""
            for m in _KIND.finditer(window):
                kind, near = m.lastgroup, "near" if len(window) - m.end() <= 24 else "far"
            left = len(re.search(rf"(?:{_NAME}[ ])*$", text[max(0, start - 60) : start]).group())
            f = [f"b1={_shape(b1)}", f"b21={_shape(b2)}_{_shape(b1)}", f"fresh={fresh}", "bias"]
            found = self._before[start] = (b1.lower(), b2.lower(), fresh, f, kind + near, left)
        return found

    def after(self, end: int) -> tuple[str, list[str], bool, int]:
        """The token after, features of it, whether a sum is named, letters of a run of names on the right."""
        if (found := self._after.get(end)) is None:
            tokens = _TOKEN.findall(self.text[end : end + 30])
            a1 = tokens[0] if tokens else ""
            summed = bool(_SUM_AFTER.match(self.text[end : end + 12].lower()))
            right = len(re.match(rf"(?:[ ]{_NAME})*", self.text[end : end + 60]).group())
            found = self._after[end] = (a1.lower(), [f"a1={_shape(a1)}"], summed, right)
        return found


def _features(around: Surroundings, start: int, end: int, label: str) -> list[str]:
    """Features of a whole span under a label."""
    span = around.text[start:end]
    b1, b2, fresh, f, kind, left = around.before(start)
    a1, after, summed, right = around.after(end)
    f = [*f, *after]
    if label == "person":
        parts = _PART.findall(span)
        low = [p.lower() for p in parts]
        upper, run, family = span.isupper(), min(3, (left + right) // 8), low[0] in SURNAMES
        title = b1 in TITLES and (b1 not in PAIRED or b2 == PAIRED[b1])
        f += [f"n={min(7, len(parts))}", f"family={family}", f"initial={sum(p.endswith('.') for p in parts)}", f"lastinitial={parts[-1].endswith('.')}"]
        f += [f"title={title}", f"street={b1 in STREET_WORDS or b2 in STREET_WORDS and b1 == '.'}", f"group={b1 in GROUP_WORDS or b2 in GROUP_WORDS}"]
        f += [f"groupend={a1 in GROUP_WORDS or low[-1] in GROUP_WORDS}", f"place={low[-1] in PLACE_WORDS}"]
        f += [f"way={low[-1] in WAYS or a1 in WAYS}", f"waybefore={b1 == ',' and b2 in WAYS}", f"number={b1.isdigit()}", f"starts={low[0] in TITLES or low[0] in GROUP_WORDS or low[0] in STREET_WORDS}"]
        f += [f"upper={upper}", f"upper={upper}_run={run}_title={title}", f"upper={upper}_run={run}_family={family}", f"more={right > 0}_upper={upper}", f"left={left > 0}_upper={upper}"]
        f += [f"family={family}_n={min(7, len(parts))}", f"latin={span.isascii()}", f"latin={span.isascii()}_fresh={fresh}", f"latin={span.isascii()}_title={title}"]
    elif label in ("phone", "id_number"):
        digits = re.sub(r"\D", "", span)
        groups = [len(g) for g in re.findall(r"\d+", span)]
        thousands = "." in span and groups[1:] == [3] * (len(groups) - 1) and digits[0] != "0"
        lead = span[0] if span[0] in "+(" else digits[:2] if digits[:1] == "0" else "digit" if span[0].isdigit() else "letter"
        f += [f"digits={len(digits)}", f"lead={lead}", f"kind={kind}", f"groups={len(groups)}_digits={len(digits)}", f"thousands={thousands}", f"sum={summed}"]
        f += [f"plain={span.isdigit()}", f"zero={digits[:1] == '0'}_{len(digits)}", f"zero={digits[:1] == '0'}_kind={kind}", f"digits={len(digits)}_kind={kind}", f"intl={digits[:2] == '84' or digits[:4] == '0084'}_{span[0] == '+' or digits[:2] == '00'}"]
    elif label == "email":
        f += [f"dots={span.count('.') > 0}", f"at={'@' in span}"]
    else:
        f += [f"parts={min(3, span.count(','))}"]
    return [f"{label}:{x}" for x in f]


def proposals(text: str) -> list[tuple[int, int, str]]:
    """Every (start, end, label) that the patterns allow, of any length."""
    out = []
    for m in _EMAIL.finditer(text) if "@" in text or "a" in text or "A" in text else ():
        out.append((*m.span(), "email"))
    for m in _DIGITS.finditer(text):
        n = sum(c.isdigit() for c in m.group())
        if 8 <= n <= 14 and m.group().count("(") == m.group().count(")"):
            out += [(*m.span(), "phone"), (*m.span(), "id_number")]
        elif 8 <= n <= 14 and m.group()[0] == "(" and ")" not in m.group():
            out += [(m.start() + 1, m.end(), "phone"), (m.start() + 1, m.end(), "id_number")]
        elif n > 14:  # two numbers side by side
            for part in re.finditer(r"\+?\d[\d.-]{7,}\d", m.group()):
                out += [(m.start() + part.start(), m.start() + part.end(), k) for k in ("phone", "id_number")]
    out += [(*m.span(), "id_number") for m in _DOCUMENT.finditer(text)]
    for pattern in (_ADDRESS_VI, _ADDRESS_EN):
        out += [(*m.span(), "address") for m in pattern.finditer(text)]
    for m in _RUN.finditer(text):
        parts = [(m.start() + p.start(), m.start() + p.end()) for p in _PART.finditer(m.group())]
        last = len(parts) - 1
        for i in range(last):
            out += [(parts[i][0], parts[j][1], "person") for j in range(i + 1, min(last + 1, i + RUN))]
            if last - i >= RUN:
                out.append((parts[i][0], parts[last][1], "person"))
    return out


def best_segments(spans: list[tuple[int, int, str]], scores: list[float]) -> list[tuple[int, int, str]]:
    """The set of spans without overlap of the greatest total score; a span of no positive gain is left out."""
    order = sorted(range(len(spans)), key=lambda i: (spans[i][1], spans[i][0]))
    ends = [spans[i][1] for i in order]
    best = [0.0]
    take: list[bool] = []
    for n, i in enumerate(order):
        with_it = scores[i] + best[bisect_right(ends, spans[i][0], 0, n)]
        take.append(with_it > best[-1])
        best.append(max(best[-1], with_it))
    out, n = [], len(order)
    while n:
        if take[n - 1]:
            out.append(spans[order[n - 1]])
            n = bisect_right(ends, spans[order[n - 1]][0], 0, n - 1)
        else:
            n -= 1
    return out[::-1]


def _marginals(spans: list[tuple[int, int, str]], scores: list[float]) -> list[float]:
    """Probability of each span under all sets of spans without overlap."""
    points = sorted({p for s, e, _ in spans for p in (s, e)})

    def add(a: float, b: float) -> float:
        return max(a, b) + log(1 + exp(-abs(a - b)))

    ahead, back = [0.0] * len(points), [0.0] * len(points)
    ending, starting = defaultdict(list), defaultdict(list)
    at = {p: i for i, p in enumerate(points)}
    for i, (s, e, _) in enumerate(spans):
        ending[at[e]].append(i)
        starting[at[s]].append(i)
    for p in range(len(points)):
        ahead[p] = ahead[p - 1] if p else 0.0
        for i in ending[p]:
            ahead[p] = add(ahead[p], ahead[at[spans[i][0]]] + scores[i])
    for p in range(len(points) - 1, -1, -1):
        back[p] = back[p + 1] if p + 1 < len(points) else 0.0
        for i in starting[p]:
            back[p] = add(back[p], back[at[spans[i][1]]] + scores[i])
    whole = ahead[-1]
    return [min(1.0, exp(ahead[at[s]] + scores[i] + back[at[e]] - whole)) for i, (s, e, _) in enumerate(spans)]


# --- sentences to learn from ---------------------------------------------------------------

_FAMILY = sorted(SURNAMES)
_MIDDLE = "Hữu Đức Thanh Ngọc Quang Xuân Bảo Hoài Nhật Thùy Tuấn Diệu Quốc Đình Thế".split()
_GIVEN = "Bình Cường Dũng Hải Khánh Lan Nam Oanh Phúc Quân Tâm Uyên Vinh Yến Thịnh Trinh Loan Nga Hương Tú Kiệt Huy".split()
_FIRST = "Alden Corin Edric Fara Garrick Helene Ivo Kester Lorna Nessa Orla Rowan Sabine Una Martin Julia Pierre Claire Thomas Emma".split()
_LAST = "Ashcombe Birkdale Dunstan Everleigh Farrow Greaves Hollis Ingram Kersey Mercer Northam Overton Prescott Ravens-Dale Sefton Moreau Lambert Carter Wilson".split()
_PLACES = "Hòa Tân Phú Khánh Yên Vĩnh Lộc Đông Bắc Thạnh Định Thới".split()
_LATIN = "Marbury Tolland Eastwick Pendrell Kingsmere Hartwell Wexley".split()

_WITH_PERSON = """Hôm qua ông {p}{x} ghé cửa hàng.|Chiều nay bà {p}{x} dạy môn toán lớp bốn.|Cô {p}{x} thắng giải chạy bộ của thành phố.|Thầy giáo trẻ {p}{x} soạn bài rất kỹ.|Bưu kiện này của {p}{x} để ở quầy.|Người nấu bếp {p}{x} chưa về.
{p}{x} thích trồng hoa trước sân.|{p}{x} bơi rất giỏi.|{p}{x} hát rất hay.|{p}{x} chưa ăn sáng.|{p}{x} đá bóng.|{t} {p}{x} giữ máy.|Bức tranh do {p}{x} vẽ năm ngoái.|Bài thơ của {p}{x} được đăng báo.|Xin cảm ơn anh {p}{x} và em {p} đã giúp.|Khách mời tên {p}{x} ngồi bàn số ba.|- {p}{x} nộp phí|Luật sư {p}{x} nghỉ phép.|Con trai của chị {p}{x} học vẽ.|Trọng tài {p}{x} thổi còi.|có mặt: {p}{x}, {p}, {p}.|Tác giả {p}{x} viết cuốn sách mỏng.|Nhân chứng {p}{x} ở xa.|bác {p}{x} đi chợ
Mr {w}{x} plays the violin.|Yesterday Mrs {w}{x} baked three pies.|A song written by {w}{x} won the prize.|{w}{x} grew up on a farm.|The goal was scored by {w}{x} in June.|We had lunch with {w}{x} on Monday.|Dr {w}{x} treats horses.|Un roman de {w}{x} vient de sortir.|Mme {w}{x} aime le thé.|M. {w}{x} joue aux échecs.|Un livre de M. {w}{x} est tombé.|On danse avec M. {w}{x} ce soir.|signé par M. {w}{x}|{w}{x} chante à l'opéra.|Ms {w}{x} paints ships.|Witness {w}{x} came late.|Coach {w}{x} whistled; {w} ran."""
_WITH_VALUE = """Thư mời xin trả lời vào {e} nhé.|mail {e}|Đặt bánh qua {e} hoặc tại quầy.|(<{e}>) là hòm thư chung.|e-mail:{e};|Write to {e} for tickets.|My mail is {e} and I read it daily.|Écrivez à {e} pour réserver.|Mail: {e}|ảnh do {e} gửi
SĐT {t}|Đặt bàn gọi {t} trước sáu giờ.|Số máy bàn {t} bận suốt.|Nhà xe báo {t} là đường dây nóng.|Hotline {t}|Zalo {t} nhé|Call {t} for a taxi.|Phone: {t}|Tel {t}|You may ring {t} at any hour.|Appelez le {t} le matin.|Tél {t}|Điện thoại {t}.|Quán để {t} trên bảng hiệu.|The plumber left {t} on the door.|chị ghi {t} lên giấy|tin nhắn của {t} đến lúc khuya
số CCCD của em là {i}|CMND {i} làm ở quê.|thẻ căn cước mới: {i}|Passport {i} expired in May.|Her ID is {i}.|identity number {i} on the form|Hộ chiếu {i} còn hạn.|Hộ chiếu ({i}) để trong cặp.|passeport {i} perdu à la gare|CNI {i}|mã định danh ghi {i}|giấy tờ {i}, bản sao kèm|ID no. {i}|tùy thân ({i})
Quán phở ở {a} rất ngon.|Nhà tôi: {a}|Chở tủ đến {a} trước trưa.|Tiệm sách {a}|số nhà {a}.|They moved to {b} in May.|The bakery at {b} opens early.|Home: {b}|Elle habite {b} depuis un an.|Xưởng mộc đặt tại {a} và thuê thợ."""
_WITHOUT = """In mã vạch {c} lên thùng sữa.|Đơn hàng mã {c} giao chậm.|Tài khoản {c} mở hôm qua.|Vé số {n}/{d} trúng thưởng.|Xe chạy lúc {n} giờ, ngày {n}/{n}/20{d}.|tra cứu vận đơn {c}|Hóa đơn {c} in mờ.|Chiếc xe giá {m} đồng.|Tiền thuê {m} đồng mỗi quý.|Số tiền {m} VND đã chuyển.|Lương tháng {m} đồng.|Máy có mã {c} ở nắp.|Căn hộ trị giá {m} đồng.|mã {c}
Trường tiểu học {q} có sân rộng.|Ngân hàng {q} mở cửa muộn.|Công ty {q} bán kem.|Công ty TNHH {q} chuyển kho.|phố {q} đông vui|Cầu {q} dài {n} mét.|Sông {q} chảy chậm.|Đường {q} ngập nước.|Xã {q} trồng chè.|Tòa án quận {q} xa nhà.|Cty Cổ phần Gốm {q1} tuyển thợ.|Bến xe số {n} đường {q} rất cũ.
Order code {c} is on its way.|Barcode {c} would not scan.|The account {c} was opened online.|Invoice {c} is paid.|It costs {m} dollars.|The {l1} Bank opens at nine.|{l1} Street was full of snow.|The {l1} School won; see {l1} v. {l2}.|{l1} Freight Ltd moved.|The {l1} District Court closed for lunch.|The Court of {l1} Vale sat late.|A walk in {l1} Park.|Le code {c} ne marche pas.|La facture {c} est payée.|La société {l1} Transport vend du bois.|La rue {l1} Vale est calme.|Le tribunal de {l1} Vale siège.|We sailed past {l1} Bay near {l2} Town.
Điều {n}. Cách Chơi Cờ Và Tính Điểm|MỤC {n}. LỊCH TẬP VÀ THI ĐẤU|HƯỚNG DẪN LÀM BÁNH VÀ NẤU CHÈ|{q} {q1} Garden opens|Kho lạnh mã {c} nằm cuối dãy."""


#: Sentences without any name, which in capitals look like runs of names.
_PLAIN = """Hà mã ngủ dưới nước cả ngày còn trâu thích nằm bùn.|Đàm phán giá vé kéo dài suốt buổi chiều.|Vũ trụ lớn hơn ta tưởng và lý lẽ ấy khó bác bỏ.|Cao nguyên mùa này nhiều gió nên lưu ý mặc ấm.|Chu kỳ giặt của máy mới ngắn hơn máy cũ.
Thái bánh mì thành lát mỏng rồi nướng vàng.|Mai mốt trời mưa thì nghỉ tập.|Dương cầm đặt cạnh cửa sổ.|Từ sáng đến trưa xe buýt đông khách.|Kim đồng hồ chỉ sai giờ, mã lực của xe yếu.|Ông bụt hiện lên hỏi vì sao con khóc.|Giang hồ là chuyện trong phim.|Trần nhà quét vôi trắng, tường sơn xanh.|Tô cháo nóng đặt trên bàn, quách thạch lựu đỏ.
The old bridge was painted green, then the fair began.|Snow fell all night and the children built a fort.|Le chat dort sur le toit pendant que la pluie tombe.|A good loaf needs flour, water, salt and a little time.|Nous avons mangé des prunes sous un arbre.|Step after step the climbers went up, in fog and in rain, by rope or by hand, till they saw the sea.|Bread is sold by weight in this town and eggs are sold by number.|Un pas après l'autre elle monte, par tous les temps, vers le lac et la forêt.|Đồng lúa chín vàng, khương gừng thơm nồng trong bếp.""".replace("\n", "|").split("|")


def _made(r: random.Random) -> tuple[str, list[tuple[int, int, str]]]:
    """A made-up text with its true segments."""

    def digits(n: int) -> str:
        return "".join(r.choice("0123456789") for _ in range(n))

    def person() -> str:
        middle = r.choice([r.choice(_MIDDLE), r.choice("ABCDGHKLMNTVX") + "."])
        parts = [r.choice(_FAMILY).title(), middle, r.choice(_GIVEN)]
        if r.random() < 0.1:
            del parts[1]
        while r.random() < 0.2:
            parts.insert(-1, r.choice(_GIVEN))
        name = " ".join(parts)
        return name.upper() if r.random() < 0.15 else name

    def western() -> str:
        return f"{r.choice(_FIRST)} {r.choice('ABCDKRT') + '. ' if r.random() < 0.3 else ''}{r.choice(_LAST)}"

    def phone() -> str:
        a, b, c = r.choice("3578") + digits(1), digits(3), digits(4)
        s = r.choice([" ", ".", "-"])
        return r.choice([f"0{a}{b}{c}", f"+84{a}{b}{c}", f"+84 {a} {b} {c}", f"0{a}{s}{b}{s}{c}", f"(0{a}) {b}-{c}", f"0084-{a}-{b}-{c}", f"0{a}-{c}-{b}", f"{r.choice('23456789')}{digits(2)}-{b}-{c}"])

    def identity() -> str:
        return r.choice(["0" + digits(11), "0" + digits(11), f"0{digits(2)} {digits(3)} {digits(3)} {digits(3)}", r.choice("123") + digits(8), f"{r.choice('123')}{digits(2)} {digits(3)} {digits(3)}", r.choice("BCKNPQ") + digits(7)])

    def two(words: list[str]) -> str:
        # places, too, are called like families now and then
        return f"{r.choice(_FAMILY).title() if words is _PLACES and r.random() < 0.25 else r.choice(words)} {r.choice(words)}"

    def address() -> str:
        house = r.choice([str(r.randint(1, 400)), f"{r.randint(1, 90)}/{r.randint(1, 60)}", f"{r.randint(1, 200)}{r.choice('ABC')}"])
        way = r.choice([f" ngõ {r.randint(1, 300)} {r.choice(['phố', 'đường'])} {two(_PLACES)}", f" {r.choice(['phố', 'đường'])} {two(_PLACES)}", f", thôn {two(_PLACES)}"])
        return house + way + r.choice([f", quận {two(_PLACES)}", f", phường {two(_PLACES)}, tỉnh {two(_PLACES)}", f", TP. {two(_PLACES)}", f", xã {two(_PLACES)}"])

    def western_address() -> str:
        return f"{r.randint(1, 300)} {r.choice(_LATIN)} {r.choice(['', 'Mill '])}{r.choice(['Street', 'Road', 'Lane', 'Quay'])}, {r.choice(['East', 'Port', 'North'])} {r.choice(_LATIN)}"

    def mail() -> str:
        at = r.choice(["@", "@", "@", "[at]", " (at) ", " @ ", " [a còng] "])
        out = f"{r.choice(['shop', 'quan.an', 've_tau', 'lop4'])}{r.choice(['', digits(3)])}{at}{r.choice(['cua-hang', 'bigmail'])}{' dot ' if at == ' @ ' else '.'}{r.choice(['com', 'vn', 'net'])}"
        return out.upper() if r.random() < 0.1 else out

    gold: list[tuple[int, int, str]] = []
    text = ""

    def put(value: str, label: str) -> None:
        nonlocal text
        gold.append((len(text), len(text) + len(value), label))
        text += value

    def fill(template: str) -> None:
        nonlocal text
        for piece in re.split(r"(\{\w+\})", template):
            key = piece[1:-1] if piece.startswith("{") else None
            if key == "p":
                put(person(), "person")
            elif key == "w":
                put(western(), "person")
            elif key == "e":
                put(mail(), "email")
            elif key == "t":
                put(phone(), "phone")
            elif key == "i":
                put(identity(), "id_number")
            elif key == "a":
                put(address(), "address")
            elif key == "b":
                put(western_address(), "address")
            elif key == "x":
                kind, latin = r.random(), "{w}" in template
                if kind < 0.1:
                    text += ", "
                    put(mail(), "email")
                    text += ","
                elif kind < 0.2:
                    text += r.choice((", ID ", ", no. ")) if latin else ", giấy tờ "
                    put(identity(), "id_number")
                    text += ","
                elif kind < 0.3:
                    text += ", tel. " if latin else ", ĐT "
                    put(phone(), "phone")
                    text += ","
                elif kind < 0.4:
                    text += ", of " if latin else ", ở số "
                    put(western_address() if latin else address(), "address")
                    text += ","
                elif kind < 0.5:
                    text += ", "
                    put(western() if latin else person(), "person")
            elif key:
                text += {"c": r.choice("123456789") + digits(r.choice((7, 8, 9, 10, 11, 11, 12, 13))), "m": f"{r.randint(100, 999)}.{digits(3)}.000", "n": str(r.randint(1, 300)), "d": digits(2), "q": two(_PLACES), "q1": r.choice(_PLACES), "l1": r.choice(_LATIN), "l2": r.choice(_LATIN)}[key]
            else:
                text += piece

    every = [t for block in (_WITH_PERSON, _WITH_VALUE, _WITHOUT) for line in block.split("\n") for t in line.split("|")]
    for n in range(r.randint(1, 4)):
        text += r.choice([" ", "\n", "\n- ", " • "]) if n else ""
        fill(r.choice(every))
        if r.random() < 0.5:
            text += " " + r.choice(_PLAIN)
    return (text.upper() if r.random() < 0.1 else text), gold


@lru_cache(maxsize=1)
def trained(sentences: int = TRAINED_ON, rounds: int = 4, seed: int = 11) -> dict[str, float]:
    """Weights of the features, by stochastic gradient ascent on the conditional likelihood."""
    r = random.Random(seed)
    data = []
    for _ in range(sentences):
        text, gold = _made(r)
        spans = proposals(text)
        if spans:
            true = set(gold)
            around = Surroundings(text)
            data.append((spans, [_features(around, *x) for x in spans], [x in true for x in spans]))
    weights: dict[str, float] = defaultdict(float)
    for n in range(rounds):
        r.shuffle(data)
        rate = 0.3 / (1 + n)
        for spans, features, true in data:
            scores = [sum(weights[f] for f in fs) for fs in features]
            for p, fs, y in zip(_marginals(spans, scores), features, true, strict=True):
                if abs(y - p) > 1e-3:
                    for f in fs:
                        weights[f] += rate * ((y - p) - 0.002 * weights[f])
    return {f: round(w, 4) for f, w in weights.items() if abs(w) > 1e-3}


def segments(text: str, weights: dict[str, float]) -> list[tuple[int, int, str]]:
    """(start, end, label) of the personal information in a text, in order, as places in the text given."""
    plain, place = composed(text)
    spans = proposals(plain)
    if not spans:
        return []
    around = Surroundings(plain)
    scores = [sum(weights.get(f, 0.0) for f in _features(around, *x)) for x in spans]
    found = best_segments(spans, scores)
    return [(place[s], place[e], k) for s, e, k in found] if place else found


def mentions(documents: DataFrame) -> DataFrame:
    """(doc_id, pii, pos, length): one row for each mention; pos is the 1-based place of the value's first character.

    Null ids and null or empty texts have none; repeated rows give theirs once. Texts
    are read whole, and neither texts nor segments are cut. Row-local: no shuffle but the
    last one, which takes away repeated rows.
    """
    weights = trained()
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text")).where("doc_id is not null and text is not null")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [(k, label, s + 1, e - s) for k, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) for s, e, label in segments(t, weights)]
            if hits:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*hits, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "pii", "pos", "length"])

    return rows.mapInArrow(find, "doc_id bigint, pii string, pos bigint, length bigint").distinct()


def redacted(documents: DataFrame) -> DataFrame:
    """The documents with a typed placeholder in place of each value; other columns stay, null texts too."""
    weights = trained()

    @F.pandas_udf("string")
    def clean(texts):
        out = []
        for t in texts:
            if t:
                for s, e, label in reversed(segments(t, weights)):
                    t = t[:s] + PLACEHOLDER[label] + t[e:]
            out.append(t)
        return pd.Series(out, dtype=object)

    return documents.withColumn("text", clean(F.col("text")))


def found(documents: DataFrame) -> DataFrame:
    """p9_found: every mention of personal information."""
    return mentions(documents).select("doc_id", "pii", "pos")
