import pytest

from quillforge.llm import residue

SCHEMA = "doc_id bigint, text string, source string, sure boolean, shell string, host string"

RESIDUE = [
    "欢迎参加{{题库名称}}测评",
    "请{姓名}于${date}前完成，#{id}",
    "Dear <%= user.name %>, hello",
    "本题考查起重%score%",
    "由%(编号)s组织",
    "编号__unit_no__移交",
    "«日期»前完成",
    "本节由XX编写，[单位]审定于 20XX 年 X 月",
    "（姓名）在（地点）检修",
    "(Company) asks (role) to help",
    "Lorem ipsum dolor sit amet orandi",
    "测试测试测试测试测试",
    "asdf asdf asdf asdf",
    "某处：此段稍后填写",
    "正常内容。HTTP Status 502 – Bad Gateway",
    "NOT FOUND | 404",
    "Traceback (most recent call last):\n  File \"a.py\", line 3, in x\nKeyError: 1",
    "抱歉，服务器开小差了（错误代码：503），请稍后",
    "请启用 JavaScript 后继续浏览本页",
    "<noscript>Turn on scripts</noscript>",
    "x" * 30_000 + "。TODO: 补充内容",
]
CONTENT = [
    None,
    "",
    " 　\n",
    "。",
    "12",
    "编写通知时，模板里的 {{姓名}} 会在发送前由系统自动换成学员姓名，因此写在双花括号里的名称不要改动。",
    "In a mail template the mark {{name}} stands for the learner and is swapped by the sender.",
    "排版常识：用“lorem ipsum”一类的假文试排版面，正式印发前必须换成正文。",
    "学员反馈打开链接时出现 404 提示，核对后发现题库已改名。",
    "集合 {1, 2, 9} 表示三个档位；参见[15]和[48]，<TBM> 表中标 * 的项目。",
    "填空练习：应当____并____。Fill in: the crew must ____ the unit.",
    "变频器显示错误代码 E728 时，应划定警戒范围。Room 503 holds the hoist; its service was unavailable.",
    "网页脚本课上讲到，浏览器关闭 JavaScript 后部分按钮失效。Students compare pages with JavaScript on and off.",
    "Access to the pit was denied by the driver. Your name goes on the sheet. 降低 5%，再降 3%。",
    "测试题第 8 题的测试目的，是检验操作。应在巡检表中填写读数（填空）。",
]


# Common wordings, each on a host of its own.
COMMON = [
    "Hello [FIRST NAME], thank you for your order.",
    "Dear %FIRST NAME%, your lesson starts soon.",
    "Welcome to $NAME and have fun.",
    "Lorem ipsum",
    "HTTP ERROR 500",
    "Error 404: page could not be found",
    "Service Temporarily Unavailable",
    "Checking your browser before accessing the site.",
    "Just a moment...",
    "Sample text here. Replace with your content.",
    "Click here to edit this text",
    "Fatal error: Uncaught TypeError in /srv/www/index.php:12",
    "Uncaught ReferenceError: lesson is not defined\n    at render (app.js:10:5)",
    "Please verify you are human to continue.",
    "The lesson on valves.\n" + "阀门检修应先泄压再拆卸。" * 60 + "\nSorry, this page cannot be displayed. Try again later.",
    "{{" + "long slot name " * 20 + "}}",
]
NOT_RESIDUE = [
    "The standard [GB] and the notes [12], [A] apply; gloves cost $9 or 5% more.",
    "An error 404 means that a page was not found; the trainee looks it up.",
    "A moment later the crew moved on. Just a moment of care saves a hand.",
    "第 404 号令、503 室与 [TBM] 表均已归档。",
    "Stop at the gate (shift: 10:30) and report at 08:15.",
]


def test_common_wordings(spark):
    assert marked(spark, frame(spark, COMMON + NOT_RESIDUE)) == set(range(len(COMMON)))


def test_evidence_kinds(spark):
    """Each kind of evidence stands for itself, also where a detector knows the text."""
    text = "This store copy cannot be opened. Try again."
    rows = [f"{t}\n{text}" for t in ("Hoist checks", "Valve drills")] + ["请{{name}}", "Sorry, this page cannot be displayed. Reload it."]
    got = {(r.doc_id, r.kind) for r in residue.evidence(frame(spark, rows, lambda i: f"h{i % 2}")).collect()}
    assert got == {(0, "mismatch"), (1, "mismatch"), (0, "repeated"), (1, "repeated"), (2, "slot"), (3, "words")}


def frame(spark, texts, source=lambda i: f"host-{i}"):
    return spark.createDataFrame([(i, t, source(i), None, None, None) for i, t in enumerate(texts)], SCHEMA)


def marked(spark, df):
    return {r.doc_id for r in residue.marked(df).collect()}


def test_detectors(spark):
    got = marked(spark, frame(spark, RESIDUE + CONTENT))
    assert got == set(range(len(RESIDUE)))


def test_empty(spark):
    assert marked(spark, frame(spark, [])) == set()


@pytest.mark.parametrize("hosts,expected", [(3, True), (1, False)])
def test_host_evidence(spark, hosts, expected):
    """A refusal no detector knows counts if several hosts give it for several documents."""
    text = "Sorry, the lesson store cannot serve item 4{}"
    df = frame(spark, [text.format(i) for i in range(4)], lambda i: f"h{i % hosts}")
    assert bool(marked(spark, df)) == expected


def test_repeated_ids_and_nulls(spark):
    df = spark.createDataFrame([(1, "请{{name}}", None, None, None, None)] * 2 + [(2, "ok text", None, None, None, None)], SCHEMA)
    assert [r.doc_id for r in residue.marked(df).collect()] == [1]
    assert residue.content(df).count() == 1 and residue.content(df).columns == df.columns
