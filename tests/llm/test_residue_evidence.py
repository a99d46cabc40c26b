from quillforge.llm import residue

DRILL = "选项 B 错在忽略了操作票漏签一项，选项 A 才完整地记录异常时刻。"
SHORT = "雨后地面湿滑时，班组长应先记录异常时刻，再牵引托盘堆垛。"
# Wordings no detector lists.
RESPONSES = [
    "Unfortunately this resource is temporarily unavailable. Please check back in an hour.",
    "We are unable to display the requested page. Contact support if this continues.",
    "Your session has expired. Sign in again to go on.",
    "This link has been removed. Return to the home page.",
    "Sorry, that website is offline right now; refresh in a few minutes.",
    "很抱歉，您访问的网页暂时无法显示，请刷新后查看。",
    "对不起，链接已失效，请返回首页。",
    "服务器正在维护，请过一会儿重新打开。",
    "网络连接超时，请检查后重新加载。",
    "您没有查看该资源的权限，请联系管理员。",
    "Quarterly crane inspection\nThis page could not be retrieved. Go back.",
    "Page unavailable\nSorry, this page cannot be shown.",
]
CONTENT = [
    DRILL,
    SHORT,
    "学员登录失败时应先检查网络，再联系管理员核对账号。",
    "When the page cannot be loaded, the trainee should refresh it and contact support; for example after a power cut.",
    "The hoist is unavailable until the crew returns it to the store.",
    "若阀门无法打开，应停止操作并通知调度台，不得强行扳动。",
    "钥匙找不到时，先登记再联系值班电工。",
    "Sorry seems the hardest word for a foreman who could not find the missing tag.",
    "网络机柜\n网络机柜接线失败后，应核对机柜编号再合闸，网络恢复后记录读数。",
]


def frame(spark, texts, source=lambda i: f"host-{i}"):
    return spark.createDataFrame([(i, t, source(i)) for i, t in enumerate(texts)], "doc_id bigint, text string, source string")


def marked(spark, df):
    return {r.doc_id for r in residue.marked(df).collect()}


def test_copied_drills_stay_content(spark):
    """A drill is content however often and on however many hosts it is given."""
    texts = [DRILL] * 9 + [SHORT] * 9
    assert marked(spark, frame(spark, texts, lambda i: f"h{i % 3}")) == set()
    assert marked(spark, frame(spark, texts)) == set()


def test_evidence_is_a_share(spark):
    """More rows of the same kinds change no decision; a response among many other pages of its hosts is not common there."""
    text = "Sorry, the lesson store cannot serve item {}"
    few = [text.format(7), text.format(8), DRILL, SHORT]
    for copies in (1, 5):
        got = marked(spark, frame(spark, few * copies, lambda i: f"h{i % 2}"))
        assert got == {i for i in range(4 * copies) if i % 4 < 2}
    assert marked(spark, frame(spark, few[:2] + [SHORT] * 400, lambda i: f"h{i % 2}")) == set()


def test_unlisted_wordings(spark):
    """Each judged alone, on a host of its own: no copies, no hosts to compare."""
    got = marked(spark, frame(spark, RESPONSES + CONTENT))
    assert got == set(range(len(RESPONSES)))


def test_title_and_slug(spark):
    """One text under other titles, or under a slug it has nothing in common with, is a response; under its own it is not."""
    text = "This copy cannot be opened. Try again."
    titled = [f"{t}\n{text}" for t in ("Hoist checks", "Valve drills")]
    assert marked(spark, frame(spark, titled)) == {0, 1}
    assert marked(spark, frame(spark, [text], lambda i: "crane-wire-checks")) == {0}
    assert marked(spark, frame(spark, [text], lambda i: "host-1")) == set()
    told = "Crane wire: this crate cannot be opened. Try again with the crane wire."
    assert marked(spark, frame(spark, [told], lambda i: "crane-wire-checks")) == set()
