"""Scalar text functions as Catalyst expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import cache
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .batches import ROWS

# fixed values: stop words of the term index
STOP_WORDS = (
    "的 了 是 在 有 和 就 不 人 都 一 一个 上 也 很 到 说 要 去 你 会 着 没有 看 好 自己 这 那 么 于 把 或 又 可以 为 "
    "因为 所以 但是 如果 这样 还是 比较 非常 已经 可能 应该 需要 通过 进行 使用 具有 包括 以及 等等 相关 主要 基本 一般 特别 尤其 例如 比如"
).split()
# fixed values: terms that make a title's tags
TITLE_TERMS = "ADC PWM UART SPI I2C GPIO LCD LED Touch ROM RAM EEPROM Flash 电压 频率 封装 引脚 功耗 温度 精度 分辨率 通道 定时器 中断 看门狗".split()
# fixed values: technical terms
TECHNICAL_TERMS = "PWM ADC 中断 寄存器 引脚 管脚 时钟 分频 采样 转换 配置 使能 禁用 模式 功耗 电流 电压 频率 精度 分辨率 通道 缓冲 滤波 触发 同步 异步 串行 并行 通信 协议".split()
# fixed values: what a chunk must mention to be admitted
ADMITTING = "芯片 寄存器 引脚 管脚 PWM ADC 中断 定时器 工作模式 电路 功能 配置 特性 参数".split()
# fixed values: query synonyms
SYNONYMS = {"MCU": ["微控制器", "单片机", "芯片"], "驱动": ["控制", "驱动器"], "传感器": ["感测器", "检测器"], "通信": ["通讯", "连接"], "低功耗": ["省电", "节能"]}

STRIP = r"(?U)^\s+|\s+$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, STRIP, "")


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def language(c: Column) -> Column:
    """zh-cn if over a tenth of the characters are CJK, else en."""
    return F.when(count_of(c, "[\\u4e00-\\u9fff]") * 10 > F.length(c), "zh-cn").otherwise("en")


def mainly_english(c: Column) -> Column:
    letters = count_of(c, "[a-zA-Z]")
    return F.coalesce(F.try_divide(letters, letters + count_of(c, "[\\u4e00-\\u9fff]")) > 0.7, F.lit(False))


def truncated(c: Column, n: int = 200) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


#: Bytes of a text in UTF-8: letters in lower case and all others as spaces; digits and all others as spaces.
LETTERS = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalpha() else 32 for b in range(256))
DIGITS = bytes(b if 48 <= b < 58 else 32 for b in range(256))
NOT_CJK = re.compile("[^\u4e00-\u9fa5]+")
_STOP = frozenset(w.encode() for w in STOP_WORDS)


def terms_of(text: bytes) -> list[bytes]:
    """Distinct terms of a text (both in UTF-8) in order: English words, numbers, then the CJK text's 4-, 3- and 2-grams at each place."""
    found = [w for w in dict.fromkeys(text.translate(LETTERS).split()) if len(w) > 1]
    found += [w for w in dict.fromkeys(text.translate(DIGITS).split()) if len(w) > 1]
    if not text.isascii():
        # three bytes a character; near the end a longer gram is cut to one that the shorter lengths give as well
        c = NOT_CJK.sub("", text.decode()).encode()
        found += [w for w in dict.fromkeys(c[i : i + n] for i in range(0, len(c) - 3, 3) for n in (12, 9, 6)) if w not in _STOP]
    return found


def lists_of(texts: pa.Array, of: Callable[[bytes], list[bytes]]) -> pa.ListArray:
    """``of`` for each text; a null counts as empty."""
    found = [of(t or b"") for t in texts.cast(pa.binary()).to_pylist()]
    ends = pa.array([0, *accumulate(map(len, found))], pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(list(chain.from_iterable(found)), pa.binary()).cast(pa.string()))


def terms(c: Column) -> Column:
    """Distinct terms in order: English words, numbers, then the CJK text's 4-, 3- and 2-grams at each place."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([lists_of(texts.slice(a, ROWS), terms_of) for a in range(0, max(1, len(texts)), ROWS)])

    return F.arrow_udf(run, "array<string>")(c)


def title_tags(c: Column) -> Column:
    return F.filter(F.array(*[F.lit(t) for t in TITLE_TERMS]), lambda t: F.contains(F.lower(c), F.lower(t)))


def technical_keywords(c: Column) -> Column:
    known = F.filter(F.array(*[F.lit(t) for t in TECHNICAL_TERMS]), lambda t: F.contains(c, t) | F.contains(F.upper(c), F.upper(t)))
    return F.array_distinct(F.concat(known, F.regexp_extract_all(c, F.lit(r"(?U)\b([A-Z]{2,})\b"), 1)))


def normalised_query(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, r"(?U)[^一-龥\w\s]", " "), r"(?U)\s+", " "))


def expanded_query(c: Column) -> Column:
    more = [F.when(F.contains(c, F.lit(t)) & ~F.contains(c, F.lit(s)), F.lit(s)) for t, ss in SYNONYMS.items() for s in ss]
    return F.concat_ws(" ", c, *more)


def table_text(headers: Column, rows: Column, most: int, label: str) -> Column:
    """A table as lines; label: the words before the count of all rows, if there are more than ``most``."""
    cell = lambda a: F.array_join(a, " | ")
    lines = F.transform(F.slice(rows, 1, most), lambda r, i: F.concat(F.lit("行"), (i + 1).cast("string"), F.lit(": "), cell(r)))
    more = F.when(F.size(rows) > most, F.array(F.concat(F.lit(f"... ({label}"), F.size(rows).cast("string"), F.lit("行数据)"))))
    return F.array_join(F.concat(F.array(F.concat(F.lit("表头: "), cell(headers))), lines, F.coalesce(more, F.array().cast("array<string>"))), "\n")


def admitted(c: Column) -> Column:
    """Whether a chunk may go into a training set."""
    s = strip(c)
    odd = s.rlike(r"^[·•\-\s]*$") | s.rlike(r"^[\d\s.\-+]*$") | s.rlike(r"^(序号|编号|说明|功能|参数|特性|型号)\s*$")
    known = F.exists(F.array(*[F.lit(t) for t in ADMITTING]), lambda t: F.contains(c, t))
    return (F.length(s) >= 30) & ~odd & (count_of(c, "<") * 10 <= F.length(c)) & known


# fixed values: what to take out of a text before it is embedded, and what to put there
CLEANING = [(r"!\[.*?\]\(.*?\)", ""), (r"\[([^\]]*)\]\([^)]*\)", "$1"), ("[#*`]+", ""), (r"(?U)\s+", " "), (r"(?U)[^\u4e00-\u9fa5\w\s.,;:!?()\[\]{}\"（）【】｛｝，。；：！？]", "")]


def preprocessed(c: Column) -> Column:
    """Text without Markdown marks and odd characters; empty if fewer than five are left."""
    out = F.coalesce(c, F.lit(""))
    for pattern, to in CLEANING:
        out = F.regexp_replace(out, pattern, to)
    out = strip(out)
    return F.when(F.length(out) < 5, "").otherwise(out)


# ``preprocessed`` in Python, as far as words go: white space is left as it is.

_DOT = "[^\n\r\u0085\u2028\u2029]"
_IMAGE, _LINK = re.compile(rf"!\[{_DOT}*?\]\({_DOT}*?\)"), re.compile(r"\[([^\]]*)\]\([^)]*\)")
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACES = re.compile(f"[{SPACE}]+")
_KEPT = frozenset(SPACE + ".,;:!?()[]{}\"（）【】｛｝，。；：！？")
#: Alphabetic symbols and joiners, which Java counts as word characters.
_WORDLIKE = frozenset("\u200c\u200d" + "".join(chr(i) for a, b in ((0x24B6, 0x24EA), (0x1F130, 0x1F14A), (0x1F150, 0x1F16A), (0x1F170, 0x1F18A)) for i in range(a, b)))


@cache
def taken_out(c: str) -> bool:
    """Whether ``preprocessed`` takes the character out."""
    return not (c in _KEPT or c in _WORDLIKE or unicodedata.category(c) in ("Lu", "Ll", "Lt", "Lm", "Lo", "Mn", "Me", "Mc", "Nd", "Nl", "Pc"))


_GONE = bytes(b for b in range(128) if taken_out(chr(b)))
_ALNUM = bytes(b if b < 128 and chr(b).isalnum() else 32 for b in range(256))
_RUNS = re.compile("[a-zA-Z0-9]+|[\u4e00-\u9fa5]+")
_CJK = re.compile("[\u4e00-\u9fa5]")


def words_of(text: bytes, stop: frozenset[bytes], prepare: bool) -> list[bytes]:
    """Words of a text (both in UTF-8) in order: runs of letters and digits, and each two neighbouring CJK characters; stop words and single characters left out.

    ``prepare``: of the text that ``preprocessed`` makes of it.
    """
    if not prepare and not (not text.isascii() and _CJK.search(text.decode())):
        return [w for w in text.translate(_ALNUM).split() if len(w) > 1 and w not in stop]
    if prepare:
        if b"](" in text:
            text = _LINK.sub(r"\1", _IMAGE.sub("", text.decode())).encode()
        if text.isascii():
            t = text.translate(None, _GONE)
            found = t.translate(_ALNUM).split()
        else:
            t = text.decode()
            for c in filter(taken_out, set(t)):
                t = t.replace(c, "")
            found = _runs(t)
        # four characters make three pairs of six bytes at most
        if sum(map(len, found)) < 20 and _length(text.decode()) < 5:
            return []
    else:
        found = _runs(text.decode())
    return [w for w in found if len(w) > 1 and w not in stop]


def _length(text: str) -> int:
    """Characters of ``preprocessed``: white space is made one before characters between two of it go."""
    one = _SPACES.sub(" ", re.sub("[#*`]+", "", text))
    return len("".join(c for c in one if not taken_out(c)).strip(SPACE))


def _runs(text: str) -> list[bytes]:
    out = []
    for r in _RUNS.findall(text):
        if r.isascii():
            out.append(r.encode())
        else:
            # three bytes a character; one alone is no word
            b = r.encode()
            out += [b[i : i + 6] for i in range(0, len(b) - 3, 3)]
    return out
