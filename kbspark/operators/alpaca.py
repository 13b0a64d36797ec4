"""Question-answer and instruction datasets from chunks.

Text steps are columns added one after the other, so that each is computed once a row. Where the choice among
several wordings is free it goes by a hash of the chunk's id, so reruns agree.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import admitted, mainly_english, strip
from . import datasets

# fixed values: what cleaning takes out or replaces before the tables are rewritten, in order; (pattern, replacement)
CLEANING = [
    (r'(?U)colspan="?\d+"?', ""),
    (r'(?U)rowspan="?\d+"?', ""),
    (r"<[^>]*>", ""),
    (r"\$\\mathbb\{[^}]*\}\$", ""),
    (r"\$[^$]*\$", ""),
    (r"\\[a-zA-Z]+\{[^}]*\}", ""),
    (r"- MO\+", "-M0+"),
    (r'(?U)olspan="?\d+"?>', ""),
    (r"(?U)>\s*PWMPD", "PWMPD"),
    (r"(?U)^\s+|\s+$", ""),
    (r"(?U)\s+", " "),
    (r"!\[.*?\]\(.*?\)", ""),
    (r"[·•]{2,}", "·"),
    (r"</?[a-zA-Z][^>]*>", ""),
    (r"&[a-zA-Z]+;", ""),
]
# fixed values: terms and what stands for them, in order
TERMS = {
    "Feature": "特性", "Built-in": "内置", "Hardware": "硬件", "Module": "模块", "Configurable": "可配置", "Default": "默认",
    "Initial value": "初始值", "Supports": "支持", "Data units": "数据单位", "Programmable": "可编程", "Polynomial": "多项式",
    "CRC": "循环冗余校验", "Register": "寄存器", "Function": "功能", "Pin definition": "管脚定义", "Operating mode": "工作模式",
    "Configuration": "配置", "Interrupt": "中断", "Timer": "定时器", "ADC": "模数转换器", "PWM": "脉宽调制", "GPIO": "通用输入输出",
    "UART": "通用异步收发器", "SPI": "串行外设接口", "I2C": "集成电路总线", "Flash": "闪存", "RISC": "精简指令集",
    "CMSIS": "Cortex微控制器软件接口标准", "DMA": "直接存储器访问", "Cortex-M": "Cortex-M", "microcontroller": "微控制器", "core": "内核",
}
# fixed values: models, units and pairs of terms; (pattern, replacement)
UNITS = [
    (r"(?iU)Arm\s+Cortex", "ARM Cortex"),
    (r"(?U)Cortex[- ]?([MmRrAa])\d*\+?", "Cortex-$1"),
    (r"(?iU)\b(\d+)-bit\b", "$1位"),
    (r"(?iU)\bbit\b", "位"),
    (r"(?iU)\bbyte\b", "字节"),
    (r"(?iU)\bMHz\b", "MHz"),
    (r"(?iU)\bkHz\b", "kHz"),
    (r"(?iU)\bmA\b", "mA"),
    (r"(?U)精简指令集\s*\(\s*RISC\s*\)", "精简指令集(RISC)"),
    (r"(?U)直接存储器访问控制器\s*\(\s*DMA\s*\)", "直接存储器访问控制器(DMA)"),
]
# fixed values: what a description names, by the pattern that shows it
FEATURES = [
    (r"(?i)built.?in.*CRC", "内置硬件CRC校验模块"),
    (r"(?i)configurable.*initial.*value", "支持可配置的初始值设置"),
    (r"(?iU)(\d+).?bit.*data.*unit", "支持{}位数据单元处理"),
    (r"(?i)programmable.*polynomial", "具有可编程多项式功能"),
    (r"(?i)register.*configuration", "通过寄存器进行配置管理"),
    (r"(?i)pin.*definition|pin.*function", "具有明确的管脚定义和功能分配"),
    (r"(?i)operating.*mode", "支持多种工作模式"),
    (r"(?i)interrupt.*handling", "具备完善的中断处理机制"),
    (r"(?i)ADC.*采样时间|sampling.*time", "ADC模块支持可配置的采样时间"),
    (r"(?i)ADC.*转换时间|conversion.*time", "ADC具有固定的转换时间"),
    (r"(?i)ADCEN|ADC.*启动|ADC.*enable", "ADC模块具有电源控制功能"),
]
GENERAL = "{}芯片具有先进的技术特性和可靠的性能表现，适用于各种工业和消费电子应用场景。"
# fixed values: instructions by kind
INSTRUCTIONS = {
    "qa_basic": ["回答关于{}芯片的问题", "解释{}芯片的相关内容", "提供{}产品的技术信息", "根据技术文档回答问题"],
    "technical": ["说明{}芯片的技术特性", "解释{}系列的工作原理", "描述{}产品的功能特点", "介绍{}芯片的规格参数"],
    "application": ["提供{}芯片的应用指导", "说明{}产品的使用方法", "解释{}芯片的配置方法", "指导{}产品的开发应用"],
    "troubleshooting": ["解决{}芯片的常见问题", "诊断{}产品的故障现象", "提供{}芯片的故障排除方案", "分析{}产品的异常情况"],
    "selection": ["帮助选择合适的{}芯片型号", "比较{}系列产品的差异", "推荐适合的{}芯片方案", "分析{}产品的选型要点"],
    "datasheet": ["解读{}芯片的数据手册内容", "说明{}产品的电气特性", "解释{}芯片的管脚定义", "描述{}产品的封装信息"],
    "integration": ["综合分析{}芯片的多项技术特性", "整合{}产品的技术文档信息", "基于多个技术资料分析{}芯片的优势", "结合技术手册和应用指导，全面介绍{}产品"],
}
# fixed values: questions by what a text says: first match of (all of, one of, in lower case one of, questions)
QUESTIONS = [
    (["PWM"], ["位编号", "寄存器"], [], ["{}芯片的PWM寄存器有哪些位字段？", "如何配置{}的PWM相关寄存器？", "{}的PWM寄存器各位功能是什么？"]),
    (["寄存器"], ["位"], ["bit"], ["{}芯片寄存器的位定义是什么？", "详细说明{}寄存器各位的功能", "如何理解{}的寄存器配置？"]),
    (["ADC"], ["采样", "转换"], [], ["{}芯片的ADC采样时间是多少？", "{}的ADC转换特性如何？", "如何配置{}的ADC功能？"]),
    (["复位"], ["电路", "方式"], [], ["{}芯片有哪些复位方式？", "{}的复位电路是如何工作的？", "如何理解{}的复位机制？"]),
    ([], ["引脚", "管脚"], ["pin"], ["{}芯片的引脚功能定义是什么？", "如何理解{}的管脚配置？", "{}芯片各引脚的作用是什么？"]),
    ([], ["工作模式"], ["mode"], ["{}芯片支持哪些工作模式？", "如何切换{}的工作模式？", "{}芯片各工作模式的特点是什么？"]),
    ([], ["中断"], ["interrupt"], ["{}芯片的中断机制是怎样的？", "如何配置{}的中断功能？", "{}芯片支持哪些中断类型？"]),
    ([], ["定时器"], ["timer"], ["{}芯片的定时器功能如何使用？", "如何配置{}的定时器？", "{}芯片定时器的特性是什么？"]),
    ([], ["电气特性", "参数"], [], ["{}芯片的电气参数是什么？", "{}芯片有哪些技术规格？", "如何理解{}的电气特性？"]),
    ([], ["封装"], ["package"], ["{}芯片有哪些封装形式？", "{}芯片的封装规格是什么？", "如何选择{}芯片的封装类型？"]),
]
# fixed values: questions by a part of the document type's name
TYPE_QUESTIONS = [
    ("troubleshooting", ["{}芯片出现问题时如何排查？", "{}芯片常见故障的解决方法？", "如何诊断{}芯片的问题？"]),
    ("selection", ["如何选择合适的{}芯片型号？", "{}系列芯片的选型要点是什么？", "{}芯片选型时需要考虑哪些因素？"]),
    ("datasheet", ["{}芯片的技术规格说明？", "如何理解{}芯片的数据手册？", "{}芯片的详细技术参数？"]),
]
# fixed values: questions where nothing else is found
OTHER_QUESTIONS = ["请介绍{}芯片的相关信息", "{}芯片的技术特点是什么？", "关于{}芯片的技术说明", "如何理解{}芯片的功能？"]
# fixed values: instructions without a question, first match of (all of, one of, in lower case one of, instruction)
DIRECT = [
    (["PWM", "寄存器"], [], [], "详细说明{}芯片PWM相关寄存器的位定义和功能"),
    (["寄存器"], ["位", "配置"], [], "解释{}芯片寄存器的配置方法和各位功能"),
    ([], ["引脚", "管脚"], [], "介绍{}芯片的引脚定义和功能分配"),
    (["ADC"], ["采样", "转换"], [], "说明{}芯片ADC模块的工作特性和配置方法"),
    (["复位", "电路"], [], [], "解释{}芯片的复位电路和复位方式"),
    ([], ["中断"], [], "说明{}芯片的中断处理机制和配置方法"),
    ([], ["定时器"], ["timer"], "介绍{}芯片定时器功能的使用方法"),
    ([], ["工作模式"], [], "说明{}芯片支持的各种工作模式"),
    ([], ["电气特性", "参数"], [], "提供{}芯片的电气特性和技术参数"),
    ([], ["封装"], [], "介绍{}芯片的封装形式和规格"),
]
TYPE_DIRECT = [("troubleshooting", "提供{}芯片的故障排除指导和解决方案"), ("selection", "指导{}芯片的选型要点和选择方法"), ("datasheet", "解读{}芯片数据手册中的技术规格")]
OTHER_DIRECT = "介绍{}芯片的技术特性和功能"
DEFAULT_CATEGORY = "芯片"


def _filled(wording: str, *values: Column) -> Column:
    """The wording with a value in place of each pair of braces."""
    return F.format_string(wording.replace("%", "%%").replace("{}", "%s"), *values)


def _said(c: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w))
    return out


def _shows(c: Column, all_of: list[str], one_of: list[str], lower: list[str]) -> Column:
    out = F.lit(True)
    for w in all_of:
        out = out & F.contains(c, F.lit(w))
    return out & (_said(c, one_of) | _said(F.lower(c), lower)) if one_of or lower else out


def picked(choices: Column, key: Column, salt: str = "") -> Column:
    """One of an array, by the first 32 bits of the key's MD5 sum."""
    h = F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(salt)).cast("binary")), 1, 8), 16, 10).cast("long")
    return F.get(choices, F.pmod(h, F.size(choices)).cast("int"))


# Tables


def _found(c: Column, pattern: str, groups: int) -> Column:
    return F.arrays_zip(*[F.regexp_extract_all(c, F.lit(pattern), F.lit(k + 1)).alias(f"g{k}") for k in range(groups)])


def _lines(c: Column, pattern: str, groups: int, line) -> Column:
    """A line for each match whose last group, white space collapsed, is longer than five characters."""
    text = lambda m: strip(F.regexp_replace(m[f"g{groups - 1}"], r"(?U)\s+", " "))
    kept = F.filter(_found(c, pattern, groups), lambda m: F.length(text(m)) > 5)
    return F.transform(kept, lambda m: line(*[m[f"g{k}"] for k in range(groups - 1)], text(m)))


def _bit(a, name, text):
    return F.concat(F.lit("位"), a, F.lit(" - "), name, F.lit("："), text)


def _bits(a, b, name, text):
    return _bit(F.when(a == b, a).otherwise(F.concat(a, F.lit("~"), b)), name, text)


def with_tables(rows: DataFrame, column: str) -> DataFrame:
    """Texts that hold the remains of a register, ADC or timing table become a line for each entry; others keep their text."""
    c = F.col(column)
    option = lambda word: lambda a, text: F.concat(F.lit(word), a, F.lit("："), text)
    options = r"(?U)(\d+)\s*:\s*([^0-9]+?)(?=\d+\s*:|其它|说明|$)"
    kinds = {
        "pwm": (F.contains(c, F.lit("PWM")) & c.rlike("PWMPD|位编号|位符号"), F.concat(
            _lines(c, r"(?U)(\d+)~(\d+)\s*([A-Z][A-Z0-9_\[\]:]*)\s*([^0-9]+?)(?=\d+~|\d+\s*-|$)", 4, _bits),
            _lines(c, r"(?U)(\d+)\s+([A-Z][A-Z0-9_]*)\s+([^0-9]+?)(?=\d+\s+[A-Z]|$)", 3, _bit)), "PWM寄存器位定义："),
        "register": (c.rlike(r"(?U)\d+\s+[A-Z_][A-Z0-9_]*\s+[^<]+"), _lines(c, r"(?U)(\d+)\s+([A-Z_][A-Z0-9_]*)\s+([^0-9]+?)(?=\d+\s+[A-Z_]|$)", 3, _bit), "寄存器位定义如下："),
        "adc": (F.contains(c, F.lit("ADC")) & c.rlike(r"(?U)\d+\s*:\s*[^:]+"), _lines(c, options, 2, option("配置")), "ADC配置选项："),
        "timing": (c.rlike(r"(?U)\d+\s*:\s*采样时间|时钟"), _lines(c, options, 2, option("选项")), "时序配置选项："),
    }
    none = F.array().cast("array<string>")
    names = {k: f"_{k}_{column}" for k in kinds}
    out = rows
    for k, (applies, lines, _) in kinds.items():
        out = out.withColumn(names[k], F.when(applies, lines).otherwise(none))
    explained = strip(F.regexp_extract(c, r"(?U)说明\s*:\s*([^:]+?)(?:其中|$)", 1))
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r'(?U)[a-z]+span="?\d+"?>', ""), "位编号位符号说明", "寄存器位定义："), r"(?U)\s*-\s*保留.*?(?=\d|$)", "")
    text = F.when(F.lit(False), c)
    for k, (_, _, title) in kinds.items():
        made = F.concat(F.lit(title + "\n"), F.array_join(F.col(names[k]), "\n"))
        if k == "adc":
            made = F.concat(made, F.when(explained != "", F.concat(F.lit("\n\n说明："), explained)).otherwise(""))
        text = text.when(F.size(names[k]) > 0, made)
    text = text.when(c.rlike("colspan|rowspan|位编号|位符号"), plain).otherwise(c)
    return out.withColumn(column, text).drop(*names.values())


def localised(c: Column) -> Column:
    """English terms in Chinese, whole words, whatever their case; models and units in one form."""
    for term, word in TERMS.items():
        c = F.regexp_replace(c, rf"(?iU)\b{re.escape(term)}\b", word)
    for pattern, to in UNITS:
        c = F.regexp_replace(c, pattern, to)
    return c


def cleaned(rows: DataFrame, column: str) -> DataFrame:
    """The column cleaned, its tables rewritten and terms localised; null if fewer than 15 characters are left."""
    c = F.col(column)
    for pattern, to in CLEANING:
        c = F.regexp_replace(c, pattern, to)
    out = with_tables(rows.withColumn(column, c), column)
    out = out.withColumn(column, F.regexp_replace(localised(F.col(column)), "-{3,}|={3,}|_{3,}", ""))
    return out.withColumn(column, F.when(F.length(strip(F.col(column))) >= 15, strip(F.btrim(F.col(column), F.lit("- \t\n·•")))))


def parameters(c: Column) -> Column:
    """Frequency, voltage, current, temperatures and ADC times that a text states; empty if none."""
    one = lambda pattern, k=1: F.regexp_extract(c, pattern, k)
    frequency, current = r"(?iU)(\d+(?:\.\d+)?)\s*(MHz|KHz|kHz)", r"(?iU)(\d+(?:\.\d+)?)\s*(mA|µA)"
    volt, heat = r"(?U)(\d+(?:\.\d+)?)\s*V(?:\s|$)", r"(?U)(-?\d+)°C.*?(\d+)°C"
    sampling, conversion = r"(?U)采样时间[约]*(\d+)[个]*[系统]*时钟|(\d+)ns.*采样", r"(?U)转换时间[固定为]*(\d+)ns"
    has = lambda pattern: one(pattern, 0) != ""
    parts = [
        F.when(has(frequency), _filled("工作频率{}{}", one(frequency), one(frequency, 2))),
        F.when(has(volt), _filled("工作电压{}V", one(volt))),
        F.when(has(current), _filled("工作电流{}{}", one(current), one(current, 2))),
        F.when(has(heat), _filled("工作温度范围{}°C至{}°C", one(heat), one(heat, 2))),
        F.when(one(sampling) != "", _filled("ADC采样时间约{}个系统时钟", one(sampling))).when(has(sampling), _filled("ADC采样时间约{}ns", one(sampling, 2))),
        F.when(has(conversion), _filled("ADC转换时间固定为{}ns", one(conversion))),
        F.when(F.contains(c, F.lit("TADC")) & F.contains(c, F.lit("采样时间")), F.lit("ADC总转换时间 = 采样时间 + 转换时间")),
    ]
    return F.array_join(F.array_compact(F.array(*parts)), "；")


def description(c: Column, category: Column) -> Column:
    """What an English text says, in Chinese: its features, or a general line, and its parameters."""
    found = F.array_compact(F.array(*[F.when(c.rlike(p), _filled(w, F.regexp_extract(c, p, 1)) if "{}" in w else F.lit(w)) for p, w in FEATURES]))
    said = F.when(F.size(found) > 0, F.concat(F.lit("主要特性包括："), F.array_join(found, "、"), F.lit("。"))).otherwise(_filled(GENERAL, category))
    stated = parameters(c)
    return F.concat(said, F.when(stated != "", _filled(" 主要技术参数：{}。", stated)).otherwise(""))


def response(c: Column, category: Column) -> Column:
    """c: a cleaned text, whose terms are localised."""
    return F.when(mainly_english(c), description(c, category)).otherwise(c)


def questions(c: Column, category: Column, doc_type: Column) -> Column:
    """All questions that suit a text and its type, or the general ones."""
    kind = F.lower(F.coalesce(doc_type, F.lit("")))
    wordings = lambda ws: F.array(*[_filled(w, category) for w in ws])
    none = F.array().cast("array<string>")
    by_text, by_type = F.when(F.lit(False), none), F.when(F.lit(False), none)
    for all_of, one_of, lower, ws in QUESTIONS:
        by_text = by_text.when(_shows(c, all_of, one_of, lower), wordings(ws))
    for part, ws in TYPE_QUESTIONS:
        by_type = by_type.when(F.contains(kind, F.lit(part)), wordings(ws))
    both = F.concat(by_text.otherwise(none), by_type.otherwise(none))
    return F.when(F.size(both) > 0, both).otherwise(wordings(OTHER_QUESTIONS))


def direct_instruction(c: Column, category: Column, doc_type: Column) -> Column:
    kind = F.lower(F.coalesce(doc_type, F.lit("")))
    out = F.when(F.lit(False), F.lit(""))
    for all_of, one_of, lower, w in DIRECT:
        out = out.when(_shows(c, all_of, one_of, lower), _filled(w, category))
    for part, w in TYPE_DIRECT:
        out = out.when(F.contains(kind, F.lit(part)), _filled(w, category))
    return out.otherwise(_filled(OTHER_DIRECT, category))


def templates(kind: Column, category: Column) -> Column:
    """The instructions of a kind."""
    out = F.when(F.lit(False), F.array().cast("array<string>"))
    for name, ws in INSTRUCTIONS.items():
        if name != "qa_basic":
            out = out.when(kind == name, F.array(*[_filled(w, category) if "{}" in w else F.lit(w) for w in ws]))
    return out.otherwise(F.array(*[_filled(w, category) if "{}" in w else F.lit(w) for w in INSTRUCTIONS["qa_basic"]]))


def _prepared(chunks: DataFrame) -> DataFrame:
    """chunks: chunk_id, chunk_type, text, chip_category, document_type. Adds content, category; only chunks that may go in."""
    rows = chunks.where(admitted(F.coalesce("text", F.lit("")))).withColumn("content", F.col("text"))
    # a generator's row: what is asked of the content isn't put back into the steps that make it, which would be repeated for each mention
    once = cleaned(rows, "content").withColumn("content", F.explode_outer(F.array("content")))
    return once.where("content is not null").withColumn("category", F.coalesce("chip_category", F.lit(DEFAULT_CATEGORY)))


def _first(rows: DataFrame, most: int | None) -> DataFrame:
    """Documents before sections, each by id."""
    return rows if most is None else rows.orderBy((F.col("chunk_type") != "document").cast("int"), "chunk_id").limit(most)


def _question() -> list[Column]:
    kind = datasets.instruction_type(F.col("document_type"))
    return [
        picked(templates(kind, F.col("category")), F.col("chunk_id"), "instruction").alias("instruction"),
        picked(questions(F.col("content"), F.col("category"), F.col("document_type")), F.col("chunk_id"), "question").alias("input"),
    ]


def _instruction() -> list[Column]:
    return [direct_instruction(F.col("content"), F.col("category"), F.col("document_type")).alias("instruction"), F.lit("").alias("input")]


def _usable(chunks: DataFrame) -> DataFrame:
    return _prepared(chunks.where("chunk_type in ('document', 'section')"))


def qa_dataset(chunks: DataFrame, most: int | None = None) -> DataFrame:
    """(chunk_id, instruction, input, output) of document and section chunks."""
    rows = _first(_usable(chunks), most)
    return rows.select("chunk_id", *_question(), response(F.col("content"), F.col("category")).alias("output"))


def instruction_dataset(chunks: DataFrame, most: int | None = None) -> DataFrame:
    """(chunk_id, instruction, input, output) with an empty input."""
    rows = _first(_usable(chunks), most)
    return rows.select("chunk_id", *_instruction(), response(F.col("content"), F.col("category")).alias("output"))


def complete_dataset(chunks: DataFrame, most_qa: int | None = 5000, most_instructions: int | None = 3000, seed: str = "") -> DataFrame:
    """Both datasets in a shuffled order that reruns repeat: kind is qa or instruction."""
    if most_qa == most_instructions:
        # of the same chunks, which are cleaned once
        rows = _first(_usable(chunks), most_qa)
        kinds = F.array(F.struct(*_question(), F.lit("qa").alias("kind")), F.struct(*_instruction(), F.lit("instruction").alias("kind")))
        both = rows.select("chunk_id", response(F.col("content"), F.col("category")).alias("output"), F.explode_outer(kinds).alias("x"))
        both = both.select("chunk_id", "x.instruction", "x.input", "output", "x.kind")
    else:
        both = qa_dataset(chunks, most_qa).withColumn("kind", F.lit("qa")).unionByName(instruction_dataset(chunks, most_instructions).withColumn("kind", F.lit("instruction")))
    return both.orderBy(F.md5(F.concat(F.col("chunk_id").cast("string"), F.col("kind"), F.lit(seed)).cast("binary")))


def dataset_stats(rows: DataFrame) -> DataFrame:
    """One row: counts, and the lengths of all three parts; averages of an empty dataset are null."""
    n = lambda c: F.length(F.col(c))
    filled = F.count_if(strip(F.col("input")) != "")
    return rows.agg(
        F.count("*").alias("total_samples"), filled.alias("samples_with_input"), (F.count("*") - filled).alias("samples_without_input"),
        *[F.avg(n(c)).alias(f"avg_{c}_length") for c in ("instruction", "input", "output")], F.max(n("output")).alias("max_output_length"), F.min(n("output")).alias("min_output_length"),
    )
