"""Telling messages (errors, script notices, sign-in notices) from sentences of real text (used by problem 9).

A small multinomial logistic regression over words, word pairs, word beginnings and, for Chinese, characters and their
pairs. It is fitted on the labelled sentences below, a bounded sample of ``sum(map(len, LABELLED.values()))`` rows, each
time it is needed (well under a second) and always with the same result.

Defined results: a blank sentence is no message; a sentence of unknown words is no message.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np

CLASSES = ("none", "error", "script", "sign_in")
#: Log odds that a sentence of unknown words loses as a message.
UNKNOWN = 1.5
#: Regularisation and steps of the fit.
DECAY, STEPS, RATE = 2e-3, 400, 4.0

# Labelled sentences, general forms of messages and of real text that is near them.
LABELLED: dict[str, tuple[str, ...]] = {
    "error": (
        "Page not found", "The requested page does not exist.", "Sorry, the page you are looking for could not be found.", "We cannot find that page.", "This link is broken or has expired.",
        "The page you requested does not exist or was moved.", "Internal server error", "The server encountered an internal error and was unable to complete your request.", "Bad gateway", "Gateway timeout", "Service unavailable", "The service is temporarily unavailable.",
        "Something went wrong.", "Oops, something went wrong. Please try again later.", "An error occurred while processing your request.", "An unknown error has occurred.", "A problem occurred, please reload the page.",
        "Error: connection refused", "Connection timed out", "Could not connect to the database", "Database connection failed", "Failed to load resource", "Unable to load the content", "Content could not be loaded.",
        "The site is down for maintenance.", "We are performing scheduled maintenance and will be back soon.", "Too many requests, please slow down.", "Rate limit exceeded", "Request timed out.", "Invalid request", "Bad request",
        "This video is no longer available.", "This content has been removed.", "The file you requested was deleted.", "No results to display", "Fatal error: uncaught exception", "Unhandled exception in thread main", "Segmentation fault", "Null pointer exception",
        "Please wait while we verify that you are not a robot.", "Checking the security of your connection before proceeding.", "Verifying your browser, one moment please.", "One moment, we are checking your connection.", "Could not establish a connection to the server.", "Something broke on our side.", "We are sorry, this did not work.", "Access blocked by the firewall of this site.",
        "HTTP/1.1 403 Forbidden", "404 Not Found", "500 Internal Server Error", "Error 502 while fetching the data", "status: 503, reason: service unavailable", "code=404 message=not found while reading the record", "Traceback (most recent call last)", "Job failed at step 4; no output produced", "Loading the report failed. Go back to the start page.", "The report does not exist any more. Return to the overview.",
        "We could not load the list. Contact the administrator.", "We could not open the player. Reload to try again.", "Could not display the chart.", "The chart cannot be displayed.", "The report is not available at the moment.", "The record no longer exists.", "The item you asked for is not here.", "Our backend did not answer in time. Please try again.", "The upstream server did not respond.", "The recording is not available on this server.", "Oops!", "Sorry for the inconvenience.", "Our team has been notified.", "Error 500 en el servidor", "Fehler 404: nicht gefunden", "错误 503：服务不可用", "无法显示该页面", "The list is down for maintenance, back at noon.", "Failed to fetch the list.", "Unable to open the report.",
        "Die Seite wurde nicht gefunden.", "Ein unerwarteter Fehler ist aufgetreten.", "Es ist ein Fehler aufgetreten.", "Der Dienst ist vorübergehend nicht verfügbar.", "Der Inhalt konnte nicht geladen werden.", "Interner Serverfehler", "Bitte versuchen Sie es später erneut.", "Wegen Wartungsarbeiten nicht erreichbar.",
        "La página no existe.", "Se ha producido un error inesperado.", "El servicio no está disponible temporalmente.", "No se pudo cargar el contenido.", "Error interno del servidor", "Inténtelo de nuevo más tarde.", "Página en mantenimiento.",
        "Page introuvable", "Une erreur est survenue.", "Service temporairement indisponible", "页面不存在", "服务器错误", "加载失败，请重试", "系统维护中", "请求超时", "发生未知错误", "服务暂时不可用", "内容已被删除", "The resource cannot be displayed.", "Nothing to see here, the page is gone.", "Error loading data", "Not found", "Timeout", "Session could not be started", "Server busy, try again in a few minutes.",
    ),
    "script": (
        "Please enable JavaScript to continue.", "JavaScript is disabled in your browser.", "You need to enable JavaScript to run this app.", "This site requires JavaScript.", "Enable JavaScript and cookies to continue", "Your browser does not support JavaScript.",
        "JavaScript must be turned on to view this page.", "Scripts are blocked; allow them to see the player.", "Turn on scripts and reload.", "To use this page, activate JavaScript in the settings.", "This viewer only works with JavaScript enabled.", "Without scripts this page cannot be shown.",
        "We detected that JavaScript is off.", "Active scripting is needed for the map.", "JS required", "Please switch on JavaScript", "Your browser is out of date and cannot run this page.", "Please upgrade your browser to view this site.", "This page needs WebGL.",
        "Scripting is required to show the list.", "Script support is needed to display the report.", "Your browser blocks scripts, so the plot is hidden.", "Scripts are off. Turn them on and reload the page.", "Für die Liste wird JavaScript benötigt.", "Bitte Skripte erlauben, um den Bericht zu sehen.", "Se necesita JavaScript para mostrar la lista.", "Active los scripts para ver el informe.", "查看报告需要启用脚本。",
        "Bitte aktivieren Sie JavaScript.", "Diese Seite benötigt JavaScript.", "JavaScript ist deaktiviert.", "Für diese Ansicht muss JavaScript eingeschaltet sein.", "Por favor, active JavaScript.", "Esta página requiere JavaScript.", "JavaScript está desactivado en su navegador.", "Habilite JavaScript para continuar.",
        "Merci d'activer JavaScript dans votre navigateur.", "JavaScript est nécessaire pour afficher cette page.", "请启用JavaScript", "您的浏览器不支持JavaScript", "本页面需要开启脚本", "浏览器已禁用脚本",
    ),
    "sign_in": (
        "Please sign in to continue.", "You must be logged in to view this page.", "Log in to see more.", "Sign up or log in to read on.", "Your session has expired, please log in again.", "Access denied", "You do not have permission to access this resource.", "Permission denied", "This page is for members only.",
        "Authentication required", "You are not authorized to view this content.", "Subscribe now to unlock all articles.", "Get full access with a subscription.", "You have been signed out.", "Please create an account to keep reading.", "Subscribe to continue reading.", "This article is for subscribers only.", "Become a member to unlock this story.", "Register for free to view the whole text.", "You have reached your limit of free articles.", "Only registered users can see this.",
        "Ask the owner for access.", "Request access to open this document.", "You need to be signed in.", "Login required", "Enter your password to proceed.", "This account has been suspended.", "Your login has timed out.", "Invalid credentials",
        "Sign in to see the report.", "Log in first to open the list.", "Your login ran out, the list is hidden.", "Permission is needed to view this record.", "You need permission to open the report.", "Please log in again.", "This view is restricted to the staff of the site.", "Bitte anmelden, um den Bericht zu sehen.", "Keine Berechtigung für diese Liste.", "Inicie sesión para ver la lista.", "Necesita permiso para abrir el informe.", "请登录后查看列表。", "您没有权限查看该报告。",
        "Bitte melden Sie sich an.", "Zugriff verweigert", "Sie haben keine Berechtigung für diese Seite.", "Anmeldung erforderlich", "Nur für Mitglieder", "Ihre Sitzung ist abgelaufen.", "Jetzt abonnieren und weiterlesen.", "Inicie sesión para continuar.", "Acceso denegado", "No tiene permiso para ver esta página.", "Su sesión ha caducado.", "Solo para suscriptores", "Regístrese para leer el artículo completo.",
        "Connectez-vous pour continuer.", "Accès refusé", "Réservé aux abonnés", "请登录", "请先登录后查看", "没有访问权限", "登录已过期", "仅限会员查看", "需要权限才能访问",
    ),
    "none": (
        "The arm picked up the ring and placed it in the left tray.", "We moved the camera closer to the table after lunch.", "The gripper closed slowly and held the cup for ten seconds.", "The operator repeated the task three times.", "Please keep the cable away from the joint.", "Open the lid, wait a moment, then pour the water.",
        "The door could not be opened because the handle was wet.", "The drawer could not be closed with one finger.", "The motor did not respond to the first command, so we sent it again.", "The sensor did not answer until the plug was reseated.", "The second camera failed during the night and was replaced in the morning.", "The page of the notebook with the offsets is missing.",
        "Yesterday the server returned an error for a few minutes and then recovered.", "We logged the error and restarted the service.", "If you see an error, note the number and tell the crew.", "The error in position was below two millimetres.", "The mean error of the model falls with more data.", "Errors were rare after the calibration.", "The script starts the recording and stops it after a minute.", "The actor read the script twice before the scene.", "A short script converts the files to another format.",
        "JavaScript was developed in the nineties and runs in every browser today.", "The tutorial explains how to enable JavaScript in an old browser and why one might not want to.", "The trainee had switched scripts off, which is why the player stayed black.", "Students sign in at the door and get a badge.", "The crew logs in at six and hands over at two.", "Access to the hall is through the north gate.", "The supervisor gave permission to move the rack.", "The museum is free for members on Sundays.",
        "The report says that access was denied twice in March.", "The service was not available last week, so we used the spare machine.", "The valve is no longer available from the maker, so we ordered another type.", "Maintenance of the robot takes place every Friday.", "The gearbox needs maintenance after a thousand hours.", "The request was sent to the workshop and answered the same day.", "The connection between the two plates is loose.", "The time limit for the task was thirty seconds.", "The test failed because the battery was empty.",
        "The file contains the joint positions of all takes.", "The file was removed from the folder after it had been copied.", "Try again with a lower speed if the ring slips.", "Wait until the arm has come to rest.", "Reload the tray when it is empty.", "The robot is not allowed to leave the marked area.", "Nobody was allowed to enter the cell while the arm moved.", "There is nothing in the box.", "The missing screws were found under the bench.", "The object was not found in the bin, so the search started again.", "The part does not exist in this size.",
        "A gateway is a device that joins two networks.", "The manual lists what each message means.", "The word error appears in the title of the chapter.", "The sign says that visitors must register at the desk.", "He forgot his password and had to ask a colleague.", "The account of the journey was read to the class.", "She subscribed to the journal years ago.", "The browser showed the plot without delay.", "The table shows the number of requests per day.", "The internal volume of the tank is small.",
        "The unexpected noise came from the fan.", "The problem was solved by a new bearing.", "We checked the connection before we started.", "The moment the arm stopped, the light turned green.", "The load was too heavy and the arm shook.", "A timeout of two seconds is enough for this move.", "The loop waits for the next request.", "The lock was blocked by dust.", "The speed was limited to half of the maximum.", "The band is enabled in the settings of the recorder.", "Cookies and tea were served in the break.", "The robot requires a firm table.",
        "Die Tür ließ sich nicht öffnen.", "Der Greifer hielt den Becher zehn Sekunden lang.", "Der Fehler lag unter zwei Millimetern.", "Gestern fiel die Kamera kurz aus.", "Wir haben den Dienst neu gestartet.", "Das Skript wandelt die Dateien um.", "Die Anmeldung zum Kurs endet am Freitag.", "Der Zugang zur Halle ist im Norden.", "La puerta no se pudo abrir con la mano.", "El brazo colocó el anillo en la bandeja.", "El error medio fue de dos milímetros.", "Ayer la cámara falló durante unos minutos.", "El guion convierte los archivos.", "El acceso a la sala está en el norte.",
        "Das Licht ist zu hell.", "Der Tisch ist aus Holz und steht am Fenster.", "Danach war der Becher leer.", "Erst kommt der Ring, danach der Deckel.", "Die Tabelle enthält alle Werte.", "Nach dem Essen wurde nichts mehr bewegt.", "Wir wiederholen das morgen.", "Bitte prüfen, ob das Kabel fest sitzt.", "Der Arm blieb stehen, weil der Akku leer war.", "Zwischen den Platten ist eine Lücke.", "Seit Montag läuft der Versuch nicht mehr so gut.", "Ein Teil ist auf den Boden gefallen.",
        "La mesa está junto a la ventana.", "Después se movió la caja.", "El vaso no está lleno.", "Repetimos la prueba mañana porque faltaba luz.", "La tabla contiene todos los valores.", "Por favor, revise el cable.", "Entre las placas hay un hueco.", "No se cambió nada más.", "桌子在窗边。", "然后盒子被移动了。", "表里有所有的数值。", "请检查电缆。", "我们明天再试一次。", "灯光太亮了，所以停了。", "之后没有再改动。",
        "机械臂把环放进左边的托盘。", "昨天服务器出错，我们重启了它。", "误差低于两毫米。", "门打不开，因为把手湿了。", "脚本会转换文件。", "学员在门口登记。", "相机在夜里坏了，早上换了新的。", "The page was printed twice and filed.", "The content of the jar is water.", "The viewer sees the arm from the left.", "Every take is displayed on the wall.", "The cover was unable to close because of the cable.", "It took a while to load the trays on the cart.", "Loading the cart took ten minutes.", "The unit is temporarily stored in the hall.",
    ),
}

_TOKEN = re.compile(r"[a-z]+|[㐀-鿿]|[45]\d\d\b|\d+")


def tokens(sentence: str) -> list[str]:
    """Words without accents and case, single Chinese characters, and numbers as signs of two kinds."""
    plain = unicodedata.normalize("NFKD", sentence.casefold())
    plain = "".join(c for c in plain if not unicodedata.combining(c))
    return ["#status" if len(t) == 3 and t[0] in "45" and t.isdigit() else "#number" if t.isdigit() else t for t in _TOKEN.findall(plain)]


def features(words: list[str]) -> set[str]:
    """What the classifier sees of a sentence: words, beginnings of words, pairs, and whether it is short."""
    out = set(words) | {f"{w[:5]}*" for w in words if len(w) > 5} | {f"{a} {b}" for a, b in zip(["^", *words], [*words, "$"])}
    return out | {f"#short{min(len(words), 20) // 5}"}


class MessageModel:
    """Class probabilities of sentences."""

    def __init__(self, labelled: dict[str, tuple[str, ...]] = LABELLED) -> None:
        rows = [(features(tokens(s)), CLASSES.index(c)) for c, sentences in labelled.items() for s in sentences]
        names = sorted({f for r, _ in rows for f in r})
        self.index = {f: i for i, f in enumerate(names)}
        x = np.zeros((len(rows), len(names)))
        for i, (r, _) in enumerate(rows):
            x[i, [self.index[f] for f in r]] = 1.0 / np.sqrt(len(r))
        y = np.eye(len(CLASSES))[[c for _, c in rows]]
        share = y.sum(axis=0)
        weight = (y @ (len(rows) / len(CLASSES) / share))[:, None] / len(rows)
        w, b = np.zeros((len(names), len(CLASSES))), np.zeros(len(CLASSES))
        for _ in range(STEPS):
            z = x @ w + b
            p = np.exp(z - z.max(axis=1, keepdims=True))
            g = (p / p.sum(axis=1, keepdims=True) - y) * weight
            w -= RATE * (x.T @ g + DECAY * w)
            b -= RATE * g.sum(axis=0)
        self.weights, self.bias = w, b
        self._leaning: dict[str, float] = {}

    def leaning(self, word: str) -> float:
        """How much a word by itself speaks for a message rather than for real text."""
        known = self._leaning.get(word)
        if known is None:
            if len(self._leaning) > 500_000:
                self._leaning.clear()
            at = [self.index[f] for f in (word, f"{word[:5]}*") if f in self.index]
            known = self._leaning[word] = float((self.weights[at, 1:].max(axis=1) - self.weights[at, 0]).sum()) if at else 0.0
        return known

    def probabilities(self, sentence: str) -> np.ndarray:
        """Probabilities of ``CLASSES``."""
        words = tokens(sentence)
        seen = features(words)
        at = [self.index[f] for f in seen if f in self.index]
        if not words or not at:
            return np.array([1.0, 0.0, 0.0, 0.0])
        z = self.weights[at].sum(axis=0) / np.sqrt(len(seen)) + self.bias
        z[0] += UNKNOWN * (1 - len(at) / len(seen))
        p = np.exp(z - z.max())
        return p / p.sum()


@lru_cache(maxsize=1)
def message_model() -> MessageModel:
    """The model of the labelled sentences."""
    return MessageModel()
