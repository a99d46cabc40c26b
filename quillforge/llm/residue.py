"""Template residue and error-page text instead of content.

A document is marked if the text or a passage of it is an unfilled slot of a
template, stand-in text, a message of a failing or refusing site or program,
or a notice that scripts are needed.  Two kinds of evidence are combined:

* detectors: patterns that content for a reader does not hold.  Sentences that
  explain a placeholder (what a mark in a mail template stands for, what dummy
  text is used for) are taken out first, so mentioning is not being;
* evidence for what no detector knows by itself, weighed for every line that
  says what a response says (that something cannot be shown, or that scripts
  are needed), in texts of any length.  A line gets a point for that and for
  each of apology, advice and site word it holds, and for a title (the line
  before it) or address slug (``source``) that shares no content term with it;
  it loses one where those agree, where it tells of such messages, and where
  much is left besides.  Three points make a response; one may be that the same masked
  line is given for a share of the pages of the hosts that have it, on several
  hosts or under several titles.  Shares, not counts, so that more or repeated
  rows change nothing.

All patterns run in the JVM; only lines with two points or more take part in
the aggregation, by a hash of the masked line, partially aggregated before the
shuffle; pages are counted by host.

Defined cases: null, empty and blank texts and mere scraps are not marked; the
whole text is searched, whatever its length; repeated texts are each judged,
and weigh by their share; a null source is one host; a repeated id comes out
once; an empty table gives an empty result; further columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillforge.session import durable

# The wordings below are the patterns looked for.
#: Sentences that explain a placeholder rather than leave one, with a text each must hold.
EXPLAINED = (
    ("{{", r"(?:模板|template)[^。\n{}]*+(?:\{\{[^{}\n]*+\}\})[^。\n]*?(?:换成|替换|代表|stands? for|swapped)[^。\n]*"),
    ("lorem", r"[“\"']lorem ipsum[”\"'][^。.\n]*?(?:假文|dummy|filler)"),
)

_NAME = r"[\p{L}_][\p{L}\p{N}_. ]*+"
_FORM_WORDS = ("姓名", "单位", "公司", "地点", "部门", "日期", "设备名称", "数值", "号码")
_FORM_NAMES = ("company", "name", "role", "equipment", "date", "place", "department")
_STATUS = (
    "bad request",
    "unauthorized",
    "forbidden",
    "not found",
    "method not allowed",
    "request timeout",
    "gone",
    "too many requests",
    "internal server error",
    "bad gateway",
    "service unavailable",
    "service temporarily unavailable",
    "gateway timeout",
    "gateway time-out",
)
# Each detector: the lower-cased texts of which a match holds at least one (plain search, cheap), and the pattern.
# An empty tuple searches every text.
SLOTS = (
    (("{{",), r"\{\{[^{}\n]++\}\}"),
    (("${", "#{"), r"[$#]\{[^{}\n]++\}"),
    (("<%",), r"<%=?[^<>%\n]++%>"),
    (("{%",), r"\{%[^{}%\n]++%\}"),
    (("{",), rf"(?<![$#{{%])\{{{_NAME}\}}"),
    (("«",), rf"«{_NAME}»"),
    (("@@",), rf"@@{_NAME}@@"),
    (("[[",), rf"\[\[{_NAME}\]\]"),
    (("%(",), rf"%\({_NAME}\)[sd]"),
    (("%",), r"(?<![0-9０-９ ])%[\p{L}_][\p{L}\p{N}_.]++%|(?:^|(?<= ))%[\p{L}_][\p{L}\p{N}_.]++%|%[A-Z]{2,}(?:[ _][A-Z]+)*+%"),
    (("__",), r"(?<!_)__(?=[\p{L}])[\p{L}\p{N}_.]*?(?<=[\p{L}\p{N}])__(?!_)"),
    (("$",), r"\$[\p{L}_][\p{L}\p{N}_.]++\$|(?<![\p{L}\p{N}])\$[A-Z][A-Z_]{2,}+(?![\p{L}\p{N}])"),
    (("&lt;",), r"&lt;[^&<>\n]++&gt;"),
    (("<your ", "<请输入", "<enter ", "<insert "), r"(?i)<(?:your |请输入|enter |insert )[^<>\n]++>"),
    (("[",), r"(?i)\[(?:insert|enter|your|请填写|请输入|填写|此处)[^\[\]\n]*+\]|(?-i)\[[A-Z]{4,}(?:[ _-][A-Z]+)*+\]|\[[A-Z]{2,}(?:[ _-][A-Z]{2,})++\]"),
    (("此处", "填写", "请输入", "待填", "待补"), r"[【（(［](?:此处|请?填写|请输入|待填|待补)[^】）)］\n]++[】）)］]"),
    (tuple(f"{o}{w}" for w in _FORM_WORDS for o in "[【"), rf"[\[【](?:{'|'.join(_FORM_WORDS)})(?:名称|全称)?[\]】]"),
    (("全称）", "全称)"), r"[（(][\p{IsHan}]{2,6}全称[）)]"),
    (("todo", "tbd", "fixme"), r"(?:TODO|TBD|FIXME)\s*[:：]"),
    (("firstname", "lastname", "000-000", "dd/mm/yyyy", "yyyy-mm-dd"), r"FIRSTNAME|LASTNAME|\b000-000-?0000|DD/MM/YYYY|(?i:yyyy-mm-dd)"),
    (tuple(f"（{w}）" for w in _FORM_WORDS), rf"（(?:{'|'.join(_FORM_WORDS)})）[^（）\n]*+（(?:{'|'.join(_FORM_WORDS)})）"),
    (tuple(f"({w})" for w in _FORM_NAMES), rf"(?i)\((?:{'|'.join(_FORM_NAMES)})\)[^()\n]*+\((?:{'|'.join(_FORM_NAMES)})\)"),
    (("x公司", "×公司", "＿公司", "？公司", "*公司", "某公司", "xxxx ltd"), r"(?:XX+|××+|＿＿+|？？+|\*\*\*|某某某?)公司|XXXX Ltd"),
    (("20xx", "××年", "×月×日", "1xxxxxx"), r"20XX ?年|××年|×月×日|1X{6,}"),
    (("联系人", "电话", "地点"), r"(?:联系人|电话|地点)[:：](?:XX|××|＿＿|？？|某某|\*\*|（号码）|000-0)"),
)
STAND_INS = (
    (
        ("ipsum", "lorem", "dolor", "amet"),
        r"(?i)\b(?:lorem|ipsum|dolor|amet)\b(?:[ ,]+[a-z]+){0,4}?[ ,]+(?:lorem|ipsum|dolor|sit|amet)\b(?:[ ,]+[a-z]+){0,4}?[ ,]+(?:lorem|ipsum|dolor|sit|amet)\b|(?<![“\"'‘])\blorem ipsum\b(?![”\"'’])",
    ),
    (("placeholder", "dummy", "filler", "sample"), r"(?i)\b(?:placeholder|dummy|filler|sample) (?:copy|text)(?:\s*:| here\b| goes\b)"),
    ((), ("占位文字", "图片占位", "正文略", "稍后填写", "内容待定", "内容待补", "此处待补充", "这里是正文", "编者：", "请替换")),
    (("模板", "template"), r"(?:模板|示例)(?:保留|占位|待删)[行段项]?|(?:[（(【\[]此处|此处)(?:改为|改成|换成|替换为)|(?i)\b(?:keep|remove|delete) this (?:line|paragraph|text|section|page) (?:in|from|before)\b"),
    (("此处改", "此处换", "此处替"), r"[（(【\[]此处(?:改为|改成|换成|替换为)"),
    (
        (" here", ">>>", " to be ", "replace ", " edit "),
        r"(?i)\b(?:your|more|some) (?:own )?(?:text|content|title|copy) (?:about [^.\n]*? )?(?:goes )?here\b|\binsert [^\]\n.]*? here\b|>>> ?add [^<\n]*+<<<|\((?:image|photo|picture|figure|logo|chart|drawing)[^()\n]* to be (?:placed|added|inserted|supplied)\)"
        r"|\breplace (?:this |it )?with your (?:own )?(?:text|content|copy)|\bclick (?:here )?to (?:edit|add) (?:this |your )?(?:text|title|content)|\b(?:type|enter|add) your (?:text|title|content)\b",
    ),
    ((), r"(\p{L}[\p{L}\p{N}]{1,2}[ 0-9]{0,6}?)\1{3,}|(\p{L}[\p{L}\p{N}]{3,7}[ 0-9]{0,6}?)\2{2,}"),
    (("标题", "段落", "正文", "文本"), r"(标题|段落|正文|文本|小标题)[一1]\s*\1[二2]"),
)
ERRORS = (
    (
        ("traceback", "file \"", "exception", "error: ", "java.lang."),
        r"Traceback \(most recent call last\)|File \"[^\"\n]+\", line [0-9]+|\b[\p{L}.]+(?:Exception|Error): |java\.lang\.[\p{L}]+(?:Exception|Error)",
    ),
    # Stack frames of any language; what programs say when they stop.
    (tuple(f".{x}:" for x in ("java", "kt", "scala", "js", "ts", "py", "php", "rb", "cs", "go", "cpp", "rs")), r"\bat [\p{L}\p{N}_.$<>/]+ ?\([^()\s]+:[0-9]+(?::[0-9]+)?\)"),
    (("fatal", "uncaught", "unhandled", "parse error", "syntax error", "segmentation"), r"(?i)\b(?:fatal|parse|syntax) error: |\b(?:uncaught|unhandled) (?:\p{L}*(?:error|exception)|promise rejection)\b|\bsegmentation fault\b"),
    (("sql error", "undefined", "http status", "http error"), r"(?i)SQL error near|Undefined (?:variable|index|offset)|HTTP (?:Status|Error) [45][0-9][0-9]"),
    # A status code and its reason, in either order; either alone only as the beginning or the whole of a line.
    (_STATUS, rf"(?i)\b[45][0-9][0-9][ |–-]{{1,4}}(?:{'|'.join(_STATUS)})"),
    (_STATUS, rf"(?i)(?:{'|'.join(_STATUS)}) ?[|–-] ?[45][0-9][0-9]\b"),
    (_STATUS, rf"(?im)^[^\S\n]*(?:{'|'.join(x for x in _STATUS if ' ' in x)}|page not found)[^\S\n]*[.!]?[^\S\n]*$"),
    (("error 4", "error 5", "error: 4", "error: 5"), r"(?im)^[^\S\n]*error:? [45][0-9][0-9]\b(?! means| is )"),
    (("just a moment", "your browser before", "human"), r"(?im)^[^\S\n]*just a moment\b[^\p{L}\n]*$|\bchecking your browser before\b|\bverify (?:that )?you are (?:a )?human\b"),
    (
        ("access denied", "may not open", "could not load", "oops", "something went", "on this server"),
        r"Access denied\.|may not open this|We could not load|(?i:oops!)|Something went wrong|\b(?:is|was) not (?:found )?on this server",
    ),
    ((), ("系统繁忙", "请稍后再试", "加载失败", "点击重试", "没有权限访问", "会话已过期", "登录超时", "请重新登录", "页面走丢", "已被删除或下架", "秒后自动跳转", "页面不存在", "开小差")),
    (("错误代码", "错误号", "错误码"), r"[（(]错误(?:代码|号|码)[:：] ?[0-9]{3}[）)]|错误(?:代码|号|码)[:： ]*[A-Z]?[0-9]+\s*(?:请求|追踪|事件|日志)(?:编号|号)"),
)
SCRIPTS = (
    (
        ("noscript", "script", " js"),
        r"(?i)</?noscript>|requires? (?:java ?)?scripts?|javascript is (?:disabled|off)|(?:enable|switch on|turn on|allow) (?:javascript|js|scripts?|scripting)\b|does not support scripts|javascript enabled|scripts are off",
    ),
    (("javascript", "脚本"), r"(?:启用|打开|开启) ?(?:JavaScript|脚本|浏览器脚本)|(?:禁用|关闭)(?:了)?脚本|脚本(?:支持|被拦截|功能)"),
)
GROUPS = {"slot": SLOTS, "stand_in": STAND_INS, "error": ERRORS, "script": SCRIPTS}

#: Lines that pages of a site carry around their content: a copyright, a menu of three entries or more.
CHROME = r"^\s*(?:©.*|[^|]{1,12}(?: \| [^|]{1,12}){2,}|\p{L}[\p{L} ]*?(?:  \p{L}[\p{L} ]*?){2,}|(?i:skip to content)|\p{IsHan}{2,4}(?: \p{IsHan}{1,4}){2,})\s*$"
# What a response says, by kind: each kind counts once. Inability is what any response holds.
APOLOGY = r"(?i)\bsorry\b|\bapologi[sz]e|\bunfortunately\b|\bwhoops\b|抱歉|对不起|不好意思|很遗憾"
INABILITY = (
    r"(?i)\b(?:can ?not|can[’']t|could not|couldn[’']t|unable to|failed to) (?:be )?(?:show|serve|display|load|open|find|found|reach|retriev|process|complete|connect|access|deliver|fetch|render)"
    r"|\b(?:is|are) (?:currently |temporarily |not )?(?:unavailable|available|down|offline)\b|\bno longer (?:available|exists?)|\bdoes not exist|\bhas (?:expired|timed out|been (?:removed|moved|deleted))"
    r"|\b(?:not (?:allowed|permitted|authori[sz]ed)|permission) to (?:view|open|see|access)|无法(?:访问|显示|打开|加载|连接|完成|提供|处理|获取|读取|响应)"
    r"|(?:加载|访问|请求|连接|提交|读取|获取|打开|登录|响应)(?:失败|超时|出错|异常)|(?:页面|网页|链接|内容|资源|地址)[^。\n]{0,6}(?:不存在|已?(?:下线|失效|过期|删除|移除))|暂时?(?:不可用|未开放)|(?:没有|无|未获)[^。\n]{0,12}权限|找不到|拒绝访问|维护中|正在维护"
    r"|\b(?:requires?|needs?|enable|turn on|switch on|allow|without|support) (?:java ?)?(?:scripts?|scripting)\b|(?:启用|打开|开启|需要|要有)[^。\n]{0,6}(?:JavaScript|脚本)"
)
#: Lower-cased texts of which every line that matches holds one.
INABILITY_NEEDS = (
    "cannot", "can not", "can't", "can’t", "could not", "couldn", "unable to", "failed to", "available", " down", "offline", "no longer", "not exist", "has ",
    "not allowed", "not permitted", "not authori", "permission to", "script", "脚本",
    "无法", "不存在", "下线", "失效", "过期", "删除", "移除", "不可用", "未开放", "权限", "找不到", "拒绝访问", "维护中", "正在维护", "失败", "超时", "出错", "异常",
)
ADVICE = (
    r"(?i)\btry (?:again|later|once more)|\breload|\brefresh|\b(?:come|check) back|\bcontact (?:the |your |our )?(?:site |system )?(?:administrator|support|help)|\b(?:log|sign) ?in again|\bgo back|\breturn to the (?:home|previous|start)"
    r"|稍后|重试|刷新|重新(?:登录|加载|打开)|返回(?:首页|上一页|主页)|联系(?:站点|网站|系统)?(?:管理员|客服|技术支持)"
)
SITE = r"(?i)\b(?:web ?page|page|website|site|server|request|link|url|browser|session|account|network|resource|(?:java)?script)s?\b|脚本|页面|网页|链接|服务器|请求|浏览器|会话|网站|网络|网址|资源|账号|站点"
#: Words of somebody who tells of such messages rather than gives one.
TOLD = r"(?i)学员|同学|考生|用户反馈|反馈|本题|例如|比如|练习|课上|选项|应先|说明|\b(?:learner|student|trainee|crew|operator|team)s?\b|for example|\bmeans\b|\bexplain"
STOP = "the and for you your our this that with from not are was were has have been will can please www com html htm php index weekly daily brief briefing forum lesson review handout explain post item article".split()
#: Characters that may be left of a line besides the response; points that decide; share of the pages.
LEFT, POINTS, SHARE = 80, 3, 0.01


def _holds(texts: tuple[str, ...], where: Column) -> Column:
    found = F.lit(False)
    for t in texts:
        found = found | F.contains(where, F.lit(t))
    return found


def _any(detectors, text: Column, low: Column) -> Column:
    found = F.lit(False)
    for needs, pattern in detectors:
        hit = _holds(pattern, text) if isinstance(pattern, tuple) else text.rlike(pattern)
        found = found | ((_holds(needs, low) & hit) if needs else hit)
    return found


def detected(documents: DataFrame) -> DataFrame:
    """``doc_id, source, slot, stand_in, error, script, said, low``: what each detector group says of the documents with text."""
    said = F.col("text")
    for need, pattern in EXPLAINED:
        said = F.when(F.contains(said, F.lit(need)), F.regexp_replace(said, pattern, "")).otherwise(said)
    rows = documents.filter(F.col("text").isNotNull()).select("doc_id", "source", said.alias("said"))
    rows = rows.withColumn("low", F.lower("said"))
    return rows.select("doc_id", "source", *(_any(d, F.col("said"), F.col("low")).alias(n) for n, d in GROUPS.items()), "said", "low")


def _terms(c: Column) -> Column:
    """Latin words but stop words, and Han bigrams: pairs from the first and from the second character of each run."""
    c = F.lower(c)
    words = F.array_except(F.regexp_extract_all(c, F.lit(r"(?<![a-z0-9])([a-z]{3,})(?![a-z0-9])"), F.lit(1)), F.array(*map(F.lit, STOP)))
    pairs = [F.regexp_extract_all(s, F.lit("([一-鿿]{2})"), F.lit(1)) for s in (c, F.regexp_replace(c, "(?<![一-鿿])[一-鿿]", ""))]
    return F.array_union(words, F.array_union(*pairs))


def _agreement(head: Column, body: Column, least: int) -> Column:
    """1 if ``head`` shares no content term with ``body``, -1 if it does, 0 if they can't be compared."""
    terms = _terms(head)
    comparable = (head.rlike(r"(?i)[a-z]{3}") & body.rlike(r"(?i)[a-z]{3}")) | (head.rlike("[一-鿿]{2}") & body.rlike("[一-鿿]{2}"))
    return F.when((F.size(terms) < least) | ~comparable, 0).when(F.arrays_overlap(terms, _terms(body)), -1).otherwise(1)


def judged(documents: DataFrame) -> DataFrame:
    """``doc_id, host, slot, stand_in, error, script, body``: one pass over the texts.

    ``body`` is the text if it says somewhere what a response says, else null.
    """
    rows = detected(documents)
    said = F.col("said")
    body = F.when(_holds(INABILITY_NEEDS, F.col("low")) & said.rlike(INABILITY), said)
    return rows.select("doc_id", F.coalesce("source", F.lit("")).alias("host"), *GROUPS, body.alias("body"))


def weighed(rows: DataFrame) -> DataFrame:
    """``doc_id, host, words, slug, named, shell, title`` of each line that may be a response.

    The points of its words, 1, 0 or -1 for slug and title, and hashes of the
    masked line and of its title: the line before it that ends no sentence.
    """
    bare = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, INABILITY, " "), ADVICE, " "), APOLOGY, " "), SITE, " ")
    masked = lambda c: F.xxhash64(F.regexp_replace(F.lower(c), r"[\p{N}]+|[a-z]{2}-#", "#"))
    lines = F.filter(F.transform(F.split("body", r"[\r\n]+"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.rlike(CHROME))
    rows = rows.filter(F.col("body").isNotNull()).select("doc_id", "host", lines.alias("lines"))
    rows = rows.select("doc_id", "host", "lines", F.posexplode("lines").alias("i", "line")).filter(F.col("line").rlike(INABILITY))
    before = F.when(F.col("i") > 0, F.get("lines", F.col("i") - 1))
    rows = rows.withColumn("head", F.when(~before.rlike(r"[。.!?！？；;：:，,]\s*$"), before).otherwise("")).withColumn("head", F.coalesce("head", F.lit(""))).drop("lines")
    rows = rows.withColumns({"left": bare(F.col("line")), "of_title": bare(F.col("head"))})
    held = lambda p: F.when(F.col("line").rlike(p), 1).otherwise(0)
    words = F.lit(1) + held(APOLOGY) + held(ADVICE) + held(SITE) - held(TOLD) - F.when(F.length("left") > LEFT, 1).otherwise(0)
    return rows.select(
        "doc_id", "host", words.alias("words"), _agreement(F.col("host"), F.col("left"), 2).alias("slug"), _agreement(F.col("of_title"), F.col("left"), 1).alias("named"), masked(F.col("line")).alias("shell"), masked(F.col("head")).alias("title")
    )


def evidence(documents: DataFrame) -> DataFrame:
    """``doc_id, kind``: each marked document with every kind of evidence that alone would mark it.

    ``slot``, ``stand_in``, ``error``, ``script``: a detector; ``words``: a line
    of three points by its words; ``mismatch``: with those of title and slug;
    ``repeated``: with that of being given for a share of the hosts' pages.
    """
    rows = durable(judged(documents), "p9-judged")
    # Filtered after the writes: a pushed-down filter would repeat every expression.
    lines = durable(weighed(rows).withColumn("points", F.col("words") + F.col("slug") + F.col("named")), "p9-weighed")
    given = lines.filter(F.col("points") >= POINTS - 1).select("shell", "host", "title", "doc_id").distinct()
    given = given.groupBy("shell", "host").agg(F.count_distinct("doc_id").alias("n"), (F.min("title") != F.max("title")).alias("titles"))
    pages = rows.groupBy("host").agg(F.count("*").alias("pages"))
    shells = given.join(pages, "host").groupBy("shell").agg((F.sum("n") / F.sum("pages")).alias("share"), ((F.count("*") > 1) | F.max("titles")).alias("several"))
    shells = shells.filter(F.col("several") & (F.col("share") >= SHARE))
    found = rows.select("doc_id", F.explode(F.filter(F.array(*(F.when(F.col(g), F.lit(g)) for g in GROUPS)), lambda g: g.isNotNull())).alias("kind"))
    by_words = lines.filter((F.col("points") >= POINTS) & (F.col("words") >= POINTS)).select("doc_id", F.lit("words").alias("kind"))
    by_mismatch = lines.filter((F.col("points") >= POINTS) & (F.greatest("slug", "named") > 0)).select("doc_id", F.lit("mismatch").alias("kind"))
    repeated = lines.filter(F.col("points") >= POINTS - 1).join(shells, "shell", "left_semi").select("doc_id", F.lit("repeated").alias("kind"))
    return found.unionByName(by_words).unionByName(by_mismatch).unionByName(repeated).distinct()


def marked(documents: DataFrame) -> DataFrame:
    """``doc_id`` of the documents that are or hold residue."""
    return evidence(documents).select("doc_id").distinct()


def content(documents: DataFrame) -> DataFrame:
    """The documents without the marked ones, all columns kept."""
    return documents.join(marked(documents), "doc_id", "left_anti")
