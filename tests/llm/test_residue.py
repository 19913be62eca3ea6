import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from motionloom.llm.residue import Recurrent, _verdicts, hashed, judge, residue

CASES = {
    "placeholder": ["Dear {{ name }}, your take ${id} is ready.", "Task: [TODO: robot id]", "Summary of __FPS__.", "Keep it below <TASK_NAME> now.", "任务：%(fps)s，操作员：XXXX。", "Ok {task_name} done", "<insert next step> soon", "see [[operator]] and @@fps@@ or <%= x %>"],
    "filler": ["lorem ipsum lorem ipsum", "-------------", "_ _ _ _ _ _", "Blah Blah. blah blah", "n/a n/a n/a n/a n/a n/a", "示例文字, 示例文字", "test test 123, abc abc abc", "xxxxxxxxxxxx"],
    "error": ["404 Not Found\nThe page you asked for is not on this viewer.", "HTTP 503\nservice unavailable\nrequest 8-1", "Oops! Something went wrong while loading episode 5.", "错误 500\nReference 1-2", "Fehler 429: slow down", "410 - Gone", "Forbidden (403)"],
    "script": ["Please enable JavaScript to view this take.", "Für den Bericht wird JS benötigt.", "请启用脚本后再查看该轨迹。", "Scripts are blocked. Allow them for the player and try again."],
    "sign_in": ["Sign in to see the report.", "请登录后查看。", "You need permission to view this take.", "Your session has expired. Please sign in again to see the plot."],
}
KEPT = [
    None, "", "   \n ", "The guide says that {{task_name}} in the card is replaced when the card is exported.", "Yesterday the camera service answered HTTP 503 for three minutes; we logged it and restarted the service.",
    "A trainee had scripts switched off in the browser, so the player stayed black until somebody enabled JavaScript for that machine.", "The word placeholder in column notes means a rubber dummy.", "We keep sample text on the label roll so that the camera can focus on it.",
    'The payload was {"pose": [0.1, 0.2], "take": 3} and the parser accepted it.', "TODO list of the shift: re-home the arm, then lower the speed.", "After 9 tries the grasp held; the next crew should mark the episode as failed.", "Line <b>one</b> **up** and <BR> go on.",
]


@pytest.mark.parametrize("verdict,text", [(v, t) for v, ts in CASES.items() for t in ts])
def test_cases(verdict, text):
    assert judge(text)[0] == verdict


@pytest.mark.parametrize("text", KEPT)
def test_kept(text):
    assert judge(text)[0] is None


def test_long_lines_are_weighed_by_clauses():
    body = '{"timestamp":"2025-01-06T10:00:00Z","status":500,"error":"Internal Server Error","message":"could not load the viewer, the request timed out after 30 s","trace":"' + "x.y.Player.open " * 8 + '","path":"/v1/takes/7"}'
    trace = "Traceback (most recent call last): " + " ".join(f'File "/srv/viewer/part{k}.py", line {k}, in open_take' for k in range(8)) + " RuntimeError server error"
    script = "This viewer needs JavaScript, JavaScript is disabled in this browser, please enable JavaScript for the player, " * 3
    sign_in = "Please sign in to see the report, you must log in first, you do not have the permission to see this take, " * 3
    for text, verdict in ((body, "error"), (trace, "error"), (script, "script"), (sign_in, "sign_in")):
        assert len(text) > 240 and judge(text)[0] == verdict
    prose = "The crew moved the ring to the left shelf and lowered the arm while the second camera watched the tray, " * 4
    assert judge(prose + "the viewer could not load the take, " + prose)[0] is None


# Wordings that are neither in the patterns' sources nor among the labelled sentences.
UNSEEN = [
    "An unexpected error occurred.", "Error establishing a database connection", "Just a moment... Checking your browser", "Service Temporarily Unavailable", "Veuillez activer JavaScript.", "Dear [First Name],", "Hello %NAME%", "INSERT TEXT HERE",
    "Nullam quis risus eget urna mollis ornare vel eu leo.", "Subscribe to read the full article.", "We're sorry, but something broke on our end.", "HTTP Error 502", "Please turn JavaScript on and reload the page.", "You have been logged out.", "This content is available to subscribers only.",
    "Sorry, you are not allowed to access this page.", "The website is under maintenance.", "Request failed with status code 500", "Unable to connect to server", "Leider ist ein Fehler aufgetreten.", "Debe iniciar sesión.", "Your browser has JavaScript disabled.", "Please log in to your account to view this thread.", "Sorry, this page isn't available.",
    "This site can't run without JavaScript.", "The server is currently unable to handle the request.", "You must be a member to read this post.", "La página solicitada no existe.", "Sie müssen angemeldet sein, um diese Seite zu sehen.", "您没有权限访问此页面。", "请开启JavaScript后刷新页面。", "Hi ${first_name}, welcome back!", "Sed ut dolor sit amet, consectetur adipiscing elit.", "Dear [Customer Name],", "503 Service Unavailable",
]
REAL = [
    "The gripper did not answer for a second.", "The cable could not be opened by hand.", "The XXXX series motors are quiet.", "We asked for permission and got it.", "The recorder needs a script for each station.", "Error bars show one standard deviation.", "The operator could not load the tray.", "Nobody had found the page with the drawing.", "Der Roboter stand still.",
    "La cámara no vio el aro.", "机器人停在桌子旁边。", "Sorting took longer than planned because two cups were missing.", "The wrist camera was moved to a new stand.", "The visitors signed the book and went to the hall.", "The error grew with the speed of the belt.", "He lost access to the lab when the contract ended.", "The play has a script of ninety pages.", "Maintenance took two hours and went well.",
    "The magazine has many subscribers in the north.", "Open the page with the wiring plan and follow the red line.", "The part is available in three sizes.", "Two of the five requests came from the same crew.", "The brown fox lay in the sun.", "Take 404 was the best of the day.", "See [Table 2](tables.md) for the limits.", "The load fell by 30% and the speed by 20%.", "Der Deckel ging nicht auf, also haben wir ihn ersetzt.", "El robot no pudo cerrar la caja.", "这个零件已经用完了。", "A server brought the soup to the table.",
]


def test_unseen_wordings():
    found = [judge(t)[0] is not None for t in UNSEEN]
    wrong = [judge(t)[0] is not None for t in REAL]
    assert sum(found) >= 0.9 * len(UNSEEN), [t for t, f in zip(UNSEEN, found) if not f]
    assert sum(found) >= 0.9 * (sum(found) + sum(wrong)), [t for t, f in zip(REAL, wrong) if f]


def test_batches_judge_as_single_texts():
    texts = [t for ts in CASES.values() for t in ts] + UNSEEN + REAL + KEPT
    common = np.sort(np.array([hashed("w", w) for t in REAL + UNSEEN for w in (t or "").lower().split()], np.int64))
    b = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "host": pa.array([None] * len(texts), pa.string())})
    words = Recurrent("w", common)
    assert _verdicts(b, common, np.zeros(0, np.int64)) == [judge(t, words=words)[0] for t in texts]


def test_corpus_boilerplate_and_gibberish(spark):
    real = "The cork ring was moved from the left tray to the rear shelf and the arm was slow on take"
    docs = [(i, f"Home | Takes | Help\n{real} {i} with the camera on", "Viewer Pages", 0) for i in range(60)]
    docs += [(100, "Home | Takes | Help\nPlease enable JavaScript to view this take.", "viewer-pages", 0), (101, "gzwdq lekfwjv cldr dbglzkdx kcjdlz", None, 0), (102, None, None, 0), (103, "", "x", 0)]
    docs += [(104, "Home | Takes | Help", "viewer_pages", 0), (105, real * 2000, "viewer_pages", 0), docs[60]]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, verdict int")
    got = {r["doc_id"]: r["verdict"] for r in residue(d).collect()}
    assert {k for k, v in got.items() if v} == {100, 101} and got[100] == "script" and got[101] == "filler"
    assert residue(d).count() == len(docs)
    assert residue(d.where("false")).count() == 0


def test_unrelated_texts_change_no_verdict(spark):
    menu = "Overview of all takes | Crews | Sites | About us | Imprint | Contact"
    docs = [(i, f"{menu}\nForbidden (403)" if i == 0 else f"{menu}\nvelda korum besht onari luthe {i}", "small", 0) for i in range(3)]
    docs += [(i, f"velda korum besht onari luthe {i}", f"h{i}", 0) for i in range(3, 6)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, verdict int")
    other = spark.range(100, 70_100, 1, 8).select(F.col("id").alias("doc_id"), F.concat(F.lit("The crate was moved "), "id").alias("text"), F.lit("large").alias("source"), F.lit(0).alias("verdict"))
    alone = {r[0]: r[1] for r in residue(d).collect()}
    among = {r[0]: r[1] for r in residue(d.unionByName(other)).where("doc_id < 100").collect()}
    assert alone == among == {0: "error", **dict.fromkeys(range(1, 6))}
