"""Template residue, filler, error pages and script notices in place of content."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby
from operator import eq

import pandas as pd
from pyspark.sql import DataFrame

#: Words of content beside an error or script notice up to which the notice stands in place of the content.
OPENING = 45

_FENCE = re.compile(r"```.*?(?:```|\Z)|~~~.*?(?:~~~|\Z)", re.S)
_SPAN = re.compile(r"`[^`\n]{1,200}`")
_MATH = re.compile(r"\\\(.*?\\\)|\\\[.*?\\\]|\$\$.*?\$\$|\\[a-zA-Z]+(?:\{[^{}]*\})+|\\[{}]|\{\s*[\d\w]+(?:\s*,\s*[\d\w.…]+)+\s*\}", re.S)
_JSON = re.compile(r'^\s*(?:\{\s*"[^"\n]*"\s*:|\[\s*(?:\{\s*"|"|-?\d|\[\s*["\d-])).*$', re.M)
_INDENT = re.compile(r"(?: {4}|\t)[ \t]*\S")
#: Signs of code that a line shows; each counts once.
_CODE_SIGNS = [
    re.compile(r"\s*[A-Za-z_][\w.]*\([^()]*(?:\([^()]*\)[^()]*)*\)\s*[;:{]?\s*$"),
    re.compile(r"\s*(?:(?:async )?def \w+\s*\(.*|class \w+\s*(?:\([^()]*\))?:|import [\w.]+(?: as \w+)?(?:, ?[\w.]+)*;?|from [\w.]+ import .+|(?:for .+ in .+|(?:el)?if .+|else|while .+|try|with .+|except\b.*):|return(?: \S+(?: [-+*/%=<>&|]+ \S+)*)?;?|(?:public|private|static|void|int|const|let|var|function) .*[;{(])\s*$"),
    re.compile(r"\s*[a-z_][\w.]*(?:\[[^\]]*\])?\s*[-+*/]?=(?!=)\s*\S"),
    re.compile(r"(?:[(=,\[]|\breturn)\s*[frb]?[\"']"),
    re.compile(r"(?:(?<!\})\}?;|(?<!\{)\{|\):)\s*$|^\s*[}\])]+[;,]?\s*$"),
]
_CODE_START = re.compile(r"(?m)^(?: {4}|\t)|[=();{]|^\s*(?:import|from|return|class|else|try)\b")
_PROSE = re.compile(r"[^\W\d_]{2,}[ ,]+[^\W\d_]{2,}|[一-鿿]{2}")
#: Elements of HTML; a name in angle brackets that is none of them is a field.
_HTML = frozenset("a abbr article aside audio b body br button canvas center cite code col div dl dt dd em footer form font h1 h2 h3 h4 h5 h6 head header hr html i iframe img input kbd label li link main mark meta nav noscript ol option p pre q s samp script section select small span strong style sub sup svg table tbody td textarea tfoot th thead tr tt u ul var video blockquote think tool".split())

_NAME = r"[^\W\d]\w{0,30}(?:[. _-]\w{1,30}){0,3}"
#: One grammar per delimiter: (pattern, weight). A text with a total weight of 2 or more has residue. A field of weight 1
#: weighs 2 where a value should stand.
_FIELDS = [
    (re.compile(r"\{\{[{#/^&>!]?\s*" + _NAME + r"[^{}\n]{0,40}\}\}"), 2),
    (re.compile(r"[$#%]\{\s*" + _NAME + r"\s*\}"), 2),
    (re.compile(r"\{%-?\s*\w[^%\n]{0,80}%\}"), 2),
    (re.compile(r"<[%?]=?\s*\w[^<>\n]{0,80}[%?]>"), 2),
    (re.compile(r"\{[#/^]\w{1,30}\}"), 2),
    (re.compile(r"(?<![\\\w{$#%\"'])\{[^\W\d]\w{1,30}\}(?!\})"), 2),
    (re.compile(r"(?<![\\\w{$#%\"'(^_])\{\d\}(?![\w})])"), 1),
    (re.compile(r"\[\[\s*[^\W\d][\w .-]{0,30}\s*\]\](?!\()"), 2),
    (re.compile(r"%\([^\W\d]\w{0,30}\)[sdfr]"), 2),
    (re.compile(r"(?<![\w%])%[A-Z][A-Z0-9_]{1,30}%(?!\w)"), 2),
    (re.compile(r"(?<=[\s:(])%[sd](?=[\s.,;:!?)]|$)"), 2),
    (re.compile(r"##[A-Z][A-Z0-9_]{1,30}##"), 2),
    (re.compile(r"(?<![\w@.])@[a-z][a-z0-9_]{1,30}@(?![\w.])"), 2),
    (re.compile(r"(?<!\w)__[A-Z][A-Z0-9_]*__(?!\w)"), 2),
    (re.compile(r"(?<!\w)_{2,}[A-Z0-9_]*PLACEHOLDER[A-Z0-9_]*_{2,}(?!\w)"), 2),
    (re.compile(r"<(?:INSERT|ENTER|YOUR|ADD|FILL)\b[^<>\n]{0,60}>", re.I), 2),
    (re.compile(r"«[a-z_]{2,30}»"), 1),
    (re.compile(r"(?i)\[(?:insert|enter|your|add|fill|inserte|insertar|insérer|insérez|hier|bitte|вставьте|вставить|введите|put|write|type|choose)\b[^\[\]\n]{0,80}\]"), 2),
    (re.compile(r"(?i)\[[^\[\]\n]{1,60}\b(?:einfügen|eintragen|ergänzen|goes here|here|ici|aquí|tbd|todo|tba|здесь)\]"), 2),
    (re.compile(r"(?i)\[(?:tbd|todo|tba|placeholder|text|content)\]"), 2),
    (re.compile(r"[\[【](?:在此|请|此处|插入|填写)[^\[\]【】\n]{0,40}[\]】]|[\[【][^\[\]【】\n]{0,20}(?:待补充|待填写|占位)[\]】]"), 2),
    (re.compile(r"(?<![\w\]])\[(?![IVXLC]+\])[A-ZÀ-ÞА-ЯЁ][\w'/-]{1,24}(?: [\w'/-]{1,24}){0,3}\](?![(\[:])"), 1),
    (re.compile(r"(?<![\w\]])\[[A-ZА-ЯЁ][A-ZА-ЯЁ _-]{2,40}\](?![(\[:])"), 1),
    (re.compile(r"[【\[][一-鿿]{1,8}[】\]]"), 1),
]
#: What a field holds, by language.
_VALUE = re.compile(r"(?i)(?:\b|_)(?:(?:first|last|sur|user|company|full)?[ _-]?name|date|day|month|year|time|company|organi[sz]ation|address|city|country|street|phone|e-?mail|title|topic|product|amount|price|number|customer|client|recipient|sender|author|position|department|link|url|location|school|university|venue|event|subject|signature|(?:vor|nach)name|datum|firma|unternehmen|anschrift|adresse|ort|stadt|betrag|thema|titel|kunde|empfänger|nom|prénom|entreprise|société|ville|montant|sujet|titre|nombre|apellidos?|fecha|empresa|dirección|ciudad|importe|tema|título|cliente|имя|фамилия|отчество|дата|компания|организация|адрес|город|сумма|тема|название|клиент)(?:\b|_)|姓名|名字|名称|日期|公司|单位|地址|城市|金额|电话|主题|标题|客户|时间|年份")
#: What stands right before a value, whatever it is called.
_GREETING = re.compile(r"(?i)(?:\b(?:dear|hello|hi|hallo|sehr geehrte[rs]?(?: (?:herr|frau))?|liebe[rs]?|bonjour|cher|chère|estimad[oa]|hola|уважаем(?:ый|ая|ые)|здравствуйте|привет),?\s|尊敬的|亲爱的|你好，?)\s*$")
_COLON = re.compile(r"\w[*_ ]{0,3}[:：][*_ ]{0,3}$")
_IN_SENTENCE = re.compile(r"[\w,;)\]，][ ]?$")
_SET = re.compile(r"(?i)[=∈∉⊂⊆∪∩∅\\^]|\b(?:sub)?sets?\b|\bspace\b|\bkernel\b|\bvector|\bmenge|\bensemble\b|\bconjunto\b|множеств|集合")
_ANGLE = re.compile(r"<([^\W\d][\w -]{1,30})>")
_MARKS = [
    re.compile(r"(?m)^\W{0,4}(?:TODO|FIXME|TBD|TBA)\s*[:：-]"),
    re.compile(r"\b(?:TODO|FIXME|TBD)\s*:\s"),
    re.compile(r"(?m)[:：]\s*(?:TODO|TBD|TBA|N\.N\.|XXX+|\?\?\?+|_{4,}|\.{6,})\s*(?:\(|\.?\s*$)"),
    re.compile(r"\bX{4,}\b"),
    re.compile(r"(?i)\((?:to be )?(?:fill(?:ed)? in|complete[d]?|add(?:ed)?|decided?) (?:later|here)\)|\(to be (?:filled in|added|completed|written|decided|determined)\)"),
    re.compile(r"\[object Object\]"),
    re.compile(r"(?:\b[^\W\d]\w*\s*[:=]\s*(?:undefined|null|NaN|None|nil)\b[.,;]?\s*){2,}"),
    re.compile(r"(?m)^\s*[^\W\d]\w*\s*:\s*undefined\b"),
    re.compile(r"(?i)\breplace this (?:paragraph|text|sentence|section|line|passage)\b|\b(?:double-)?click (?:here )?to (?:edit|add your own)\b|\byour (?:text|content|title|summary|description|name) (?:goes )?here\b|\b(?:text|content|description|summary) goes here\b|\b(?:add|write|enter|type) your (?:own )?(?:text|content|title|description) here\b"),
    re.compile(r"(?i)\bthis (?:section|page|paragraph|part|chapter) (?:is|was|has been) (?:intentionally )?(?:left (?:blank|empty)|not (?:yet )?(?:been )?written|still to be written)|\b(?:section|description|content) (?:coming soon|to follow|to be written)\b"),
    re.compile(r"(?i)\b(?:dieser|diesen) (?:text|absatz|abschnitt) (?:hier )?(?:ersetzen|bearbeiten)\b|\bhier (?:klicken|text eingeben)\b|\bremplacez ce (?:texte|paragraphe)\b|\bcliquez ici pour modifier\b|\bsustituya este (?:texto|párrafo)\b|\breemplace este (?:texto|párrafo)\b|\bhaga clic aquí para editar\b|замените этот (?:текст|абзац)|нажмите, чтобы изменить"),
    re.compile(r"(?:请在此(?:处)?(?:输入|填写)|点击(?:此处)?编辑|替换(?:此|这)段)"),
    re.compile(r"[（(【\[]\s*(?:待补充|待填写|待完善|待定|未完成)[^）)】\]\n]{0,40}[）)】\]]"),
    re.compile(r"(?im)[(\[]\s*(?:à compléter|noch (?:zu )?ergänzen|por completar|a completar|дополнить|заполнить)[^)\]\n]{0,30}[)\]]|^\W*(?:texte )?à compléter\s*:"),
]
#: Literals of which a text holds one wherever the pattern of the same place can match; they only save time.
_FIELD_SIGNS = [("{{",), ("${", "#{", "%{"), ("{%",), ("<%", "<?"), ("{#", "{/", "{^"), ("{",), ("{",), ("[[",), ("%(",), ("%",), ("%s", "%d"), ("##",), ("@",), ("__",), ("PLACEHOLDER",), ("<",), ("«",), ("[",), ("[",), ("[",), ("[", "【"), ("[",), ("[",), ("[", "【")]
_MARK_SIGNS = [
    ("todo", "fixme", "tbd", "tba"), ("todo", "fixme", "tbd"), ("todo", "tbd", "tba", "n.n.", "xxx", "???", "____", "......"), ("xxxx",), ("(fill", "(to be", "(complete", "(add", "(decide"), ("[object",),
    ("undefined", "null", "nan", "none", "nil"), ("undefined",), ("replace this", "click", " here", "your "), ("this section", "this page", "this paragraph", "this part", "this chapter", "coming soon", "to follow", "to be written"),
    ("ersetzen", "bearbeiten", "klicken", "eingeben", "remplacez", "cliquez", "sustituya", "reemplace", "haga clic", "замените", "нажмите"), ("请", "点击", "替换"), ("待补充", "待填写", "待完善", "待定", "未完成"), ("compléter", "ergänzen", "completar", "дополнить", "заполнить"),
]
#: Words of a sentence that talks about a sign which it quotes.
_ABOUT = re.compile(r"(?i)\b(?:template|placeholder|syntax|variable|loader|escape[sd]?|notation|format string|field|token|renders?|literal(?:ly)?|written as|stands for)\b")
#: A sentence that explains how such signs are filled.
_EXPLAINS = re.compile(r"(?i)\btemplate (?:variable|tag|engine|syntax|language)s?\b|\bplaceholder syntax\b|\b(?:jinja2?|mustache|handlebars)\b|\binterpolat\w+|\b(?:is|are|gets?|will be) (?:replaced|substituted|expanded|rendered|filled in) (?:by|with|as|from|when)\b|\bin (?:double |curly |angle |square )+(?:braces|brackets)\b")
#: Sentences per field of weight 1 up to which a text has them often enough to be a form.
DENSITY = 40
_QUOTED = re.compile(r"[\"'“”„‘’]\s*$")

#: Words of the usual filler text.
_LATIN = frozenset("lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split())
_STRONG = frozenset("lorem ipsum adipiscing consectetur eiusmod incididunt ullamco aliquip nostrud exercitation laboris veniam amet tempor commodo dolore consequat magna aliqua labore nisi".split())
_MASH_SIGN = re.compile(r"\b(?:asdf|qwert|zxcv|jkl|hjkl|sdfg|dfgh|fghj|uiop|yuiop|xcvb|bla|blub|foo|bar|baz|test|йцукен|фыва|([a-z])\1{2,}\b)")
_MASH = re.compile(r"^(?:asdf\w*|qwert\w*|zxcv\w*|jkl\w*|hjkl|sdfg\w*|dfgh\w*|fghj\w*|uiop|yuiop|xcvb\w*|([a-z])\1{2,}|bla+h?|blub+|foo|bar|baz|test|йцукен|фыва\w*)$")
_FILLER = re.compile(
    r"(?i)\bdummy (?:copy|text)\b|\bbody copy goes\b|\b(?:sample|filler|placeholder|blind) text\b(?:[\s.,;]+(?:sample|filler|placeholder|blind) text\b)+|\bthis is (?:a |some )?(?:dummy|filler|placeholder|sample|blind) (?:text|copy|paragraph|content)\b"
    r"|(?:dies ist|das ist|hier steht) (?:ein |nur ein )?(?:blindtext|platzhaltertext|fülltext|beispieltext)|\bfaux texte\b|\btexte de remplissage\b|\btexte fictif\b|\b(?:este|esto) es un texto de (?:relleno|ejemplo|prueba)\b|\btexto de relleno\b|текст-рыба|рыба-текст|текст-заполнитель|占位文字|占位符|测试文字|示例文字|假文"
)
_FILLER_SIGNS = ("dummy", "body copy", "sample", "filler", "placeholder", "blind", "platzhaltertext", "fülltext", "beispieltext", "faux texte", "texte", "texto", "рыба", "текст-заполнитель", "占位", "测试文字", "示例文字", "假文")
_SKELETON = re.compile(r"(?im)^\W*(?:heading|paragraph|item|column|bullet|section|title|subtitle|row|cell|label|caption|button|link|text|image|überschrift|absatz|titre|paragraphe|título|párrafo|заголовок|абзац|标题|段落)\s*\d{1,3}\W*$")
_NAV = re.compile(r"(?i)^\W*(?:(?:home|menu|search|help|log ?in|sign ?(?:in|up)|skip to content|about|contact|tasks|runs|back to (?:home|start)|start ?page|startseite|inicio|accueil|главная|首页|register|privacy|terms|imprint|sitemap)\b[\s|·•/>-]*)+\W*$")
_CLOSED = re.compile(r"</?(?:html|head|title|body|center|h[1-6]|noscript|p|div|span|hr|br|pre|b|strong)\b[^<>]*>", re.I)

_CODE_NO = r"(?:4\d\d|50\d|51\d|52\d)"
#: Notices: what an error or block page, or a page that needs scripts, says. Each is looked for in one sentence.
_ERRORS = re.compile(
    r"(?ix)"
    rf"^\W*(?:(?:http|error|fehler|erreur|ошибка|错误|código|status|http\s*status)\W*)*{_CODE_NO}\W*[-–—:|]?\s*(?:(?:page|file)?\s*not\ found|bad\ gateway|bad\ request|forbidden|unauthorized|internal\ server\ error|service\ (?:temporarily\ )?unavailable|gateway\ time-?out|request\ time-?out|too\ many\ requests|gone|method\ not\ allowed|payload\ too\ large|conflict)?\W*$"
    rf"|^\W*(?:error|fehler|erreur|ошибка|http\ error)\s*(?:code)?\s*{_CODE_NO}\b"
    rf"|http\ status\ {_CODE_NO}|^\W*type\ status\ report|^\W*message\W+(?:service\ unavailable|gone|not\ found|bad\ gateway|forbidden|internal\ server\ error|request\ timeout|gateway\ timeout|bad\ request|too\ many\ requests|unauthorized)?\W*$"
    rf"|\"error\"\s*:|\"(?:code|status)\"\s*:\s*{_CODE_NO}"
    r"|^\W*(?:page|file)\ not\ found|\b(?:the\ )?(?:page|item|file|document|resource|content)\ (?:that\ )?(?:you(?:'re|\ are)\ looking\ for|you\ requested|requested)\b.*\b(?:not|moved|deleted|removed|exist|found|unavailable)|\b(?:could\ not|cannot|can't|couldn't)\ (?:be\ found|find\ (?:the|that|this)\ (?:page|file|item))"
    r"|^\W*access\ (?:to\ this\ (?:page|site)\ )?(?:is\ |has\ been\ |was\ )?denied|\b(?:you\ )?(?:do\ not|don't)\ have\ (?:the\ )?permission|\bpermission\ denied\b|^\W*forbidden\W*$|\byou\ (?:have\ been|are|were)\ (?:temporarily\ )?blocked\b|\byour\ (?:ip(?:\ address)?|access|request)\b.*\b(?:blocked|denied|banned|limited)"
    r"|\b(?:session|token)\ (?:has\ |is\ )?(?:expired|timed\ out)|\b(?:log|sign)\ in\ (?:again|to\ (?:continue|view|see))|\bplease\ (?:log|sign)\ in\b"
    r"|\boops\b|\bsomething\ went\ wrong\b|\bour\ side\b|^\W*try\ again\ (?:later|in\ a\ few|in\ some)|\bplease\ try\ again\b|\bcheck\ the\ address\b"
    r"|\bconnection\ (?:has\ )?(?:timed\ out|timeout|refused|reset|failed)|\bserver\ (?:took\ too\ long|is\ (?:down|busy|unavailable|overloaded)|error\b)|\bupstream\ connect\ error|\bdisconnect/reset|\btemporarily\ (?:down|unavailable|offline)|\bdown\ for\ maintenance|\bunder\ maintenance|\brate\ limit(?:ed)?\b|\btoo\ many\ (?:requests|clients|connections)"
    r"|\bdatabase\ (?:connection|error)|\bfatal\ error\b|\bmemory\ size\ exhausted|^\W*traceback\ \(most\ recent|^\W*file\ \"[^\"]+\",\ line\ \d+|^\W*\w*(?:error|exception)\s*:\s|\bunhandled\ exception|\bstack\ trace\b"
    r"|\bchecking\ (?:that|if|whether)\ you\ are\ (?:a\ )?human|\bchecking\ your\ browser|\bare\ you\ (?:a\ )?(?:human|robot)|\bnot\ a\ robot\b|\bcaptcha\b|\bverify(?:ing)?\ (?:that\ )?you\ are\ (?:a\ )?human|\bthis\ may\ take\ a\ few\ seconds|\bunusual\ traffic|\bnot\ available\ in\ your\ (?:region|country|area)|\bcloudflare\b|\bray\ id\b"
    r"|zugriff\ verweigert|sitzung\ ist\ abgelaufen|nicht\ (?:erreichbar|verfügbar|gefunden)\W|seite\ (?:wurde\ )?nicht\ gefunden|versuchen\ sie\ es\ (?:später|erneut|noch)|melden\ sie\ sich\ (?:erneut\ )?an|interner\ serverfehler|vorübergehend\ nicht"
    r"|accès\ (?:refusé|interdit)|session\ a\ expiré|(?:momentanément|temporairement)\ indisponible|page\ (?:est\ )?introuvable|n'existe\ (?:pas|plus)|veuillez\ réessayer|veuillez\ vous\ (?:re)?connecter|erreur\ interne|impossible\ de\ (?:trouver|charger|afficher)"
    r"|acceso\ (?:denegado|prohibido)|sesión\ ha\ caducado|no\ está\ disponible|no\ se\ encontró|página\ no\ (?:encontrada|existe)|int[eé]n?telo\ (?:más\ tarde|de\ nuevo)|inicie\ sesión|error\ interno|servicio\ no\ disponible"
    r"|доступ\ (?:запрещ[её]н|закрыт|ограничен)|сессия\ (?:истекла|устарела|завершена)|срок\ (?:действия\ )?сессии|страница\ (?:не\ найдена|не\ существует|удалена)|сервис\ (?:временно\ )?недоступен|временно\ недоступ|сервер\ (?:временно\ )?(?:не\ отвечает|недоступ)|(?:попробуйте|повторите).{0,20}(?:позже|позднее|снова|ещё\ раз|попытку)|внутренняя\ ошибка|войдите\ (?:снова|ещё)|^\W*ошибка\ \d{3}"
    r"|访问被拒绝|拒绝访问|没有权限|会话已(?:过期|失效)|页面(?:不存在|未找到|无法)|找不到(?:该|您|此|请求)?.{0,6}页面|服务(?:暂时)?不可用|暂时(?:无法|不可用)|服务器(?:内部)?错误|请稍后(?:再试|重试)|请重新登录|^\W*错误\W*\d{3}|网关"
)
_SCRIPTS = re.compile(
    r"(?ix)"
    r"\b(?:enable|activate|allow|turn\ on|switch\ (?:on|scripting)|switch\ .{0,20}\bback\ on|need|needs|requires?|without|support)\b.{0,40}\b(?:java-?\s?scripts?|scripts?|scripting|cookies)\b|\b(?:java-?\s?script|scripts?|scripting|cookies)\b.{0,40}\b(?:disabled|turned\ off|switched\ off|blocked|not\ (?:enabled|available|supported|allowed)|required|must\ be\ (?:on|enabled))\b|\bscript-enabled\ browser|\b(?:turn|switch)\ scripting|\bnothing\ can\ be\ displayed\ without|\bcannot\ be\ shown\b"
    r"|(?:aktivieren|einschalten|erlauben|benötig\w+|erford\w+|braucht)\b.{0,40}(?:javascript|skripte?|scripts?)|(?:javascript|skripte?|scripts?)\b.{0,40}(?:aktivier\w+|einschalten|abgeschaltet|deaktiviert|benötig\w+|erforderlich|blockiert)|ihr\ browser\ hat\ sie\ abgeschaltet"
    r"|(?:activ\w+|autoris\w+|besoin\ de|nécessite\w*|requi\w+)\b.{0,40}(?:javascript|scripts?)|(?:javascript|scripts?)\b.{0,40}(?:désactivé\w*|bloqué\w*|nécessaire\w*|requis)"
    r"|(?:active|activar|habilit\w+|permita|necesita|requiere)\b.{0,40}(?:javascript|scripts?)|(?:javascript|scripts?)\b.{0,40}(?:desactivad\w+|bloquead\w+|necesari\w+)"
    r"|(?:включите|разрешите|нужн\w+|необходим\w*|требу\w+|требует)\b.{0,40}(?:javascript|скрипт\w*|сценари\w+)|(?:javascript|скрипт\w*|сценари\w+)\b.{0,40}(?:отключен\w*|отключён\w*|выключен\w*|заблокирован\w*|нужн\w+|включ\w+)"
    r"|(?:启用|开启|允许|打开|需要).{0,12}(?:javascript|脚本)|(?:javascript|脚本).{0,12}(?:已?(?:禁用|关闭|被阻止)|支持才能|才能(?:显示|继续))"
)
#: Stems of which every notice of more than NOTICE_WORDS words has one; shorter sentences are always looked at.
NOTICE_WORDS = 5
_STEMS = ("error", "fehler", "erreur", "ошибк", "错误", "http", "status", "message", "found", "gateway", "request", "forbidden", "denied", "permission", "blocked", "banned", "limit", "expired", "timed out", "timeout", "log in", "sign in", "oops", "wrong", "our side", "again", "address", "looking for", "could", "can't", "cannot", "refused", "reset", "failed", "server", "temporarily", "maintenance", "too many", "database", "memory", "traceback", "file ", "exception", "stack trace", "human", "browser", "robot", "captcha", "seconds", "traffic", "cloudflare", "ray id", "not available", "code", "unavailable",
          "script", "cookie", "displayed", "verweigert", "abgelaufen", "nicht", "versuchen", "melden sie", "accès", "expiré", "indisponible", "introuvable", "existe", "réessayer", "connecter", "impossible", "acceso", "caducado", "disponible", "encontr", "ntelo", "inicie", "доступ", "сесси", "страниц", "недоступ", "сервер", "позже", "позднее", "снова", "попытк", "ещё раз", "войдите", "скрипт", "сценари", "skript", "abgeschaltet", "访问", "权限", "会话", "页面", "服务", "暂时", "稍后", "登录", "网关", "脚本")
_TEACH = re.compile(r"(?i)\b(?:course|teaches|lesson|tutorial|shows how|explains?|explained|chapter|lecture|answered|returned|logged|report(?:s|ed)?)\b")
_SENT = re.compile(r"(?<=[.!?。！？])\s+|(?<=[。！？])|\n+")
_WORD = re.compile(r"[一-鿿]|[^\W_一-鿿]+")


def _masked(text: str) -> str:
    """Text without code, notation and data, which use the same signs."""
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    text = _SPAN.sub(" ", _FENCE.sub("\n", text))
    return _without_code(_JSON.sub("", _MATH.sub(" ", text)))


def _without_code(text: str) -> str:
    """Text without runs of lines that look like code by two signs or more: an indent counts one, so does a line before
    that ends in a colon, and a line with another sign in which no two words follow each other. Indents alone are none."""
    if not _CODE_START.search(text):
        return text
    lines = text.split("\n")
    out: list[str] = []
    run: list[str] = []
    score = other = 0
    before = ""

    def close() -> None:
        nonlocal run, score, other, before
        if run:
            led = before.endswith((":", "："))
            if not (other or led) or score + led < 2:
                out.extend(run)
            run, score, other = [], 0, 0
            before = ""

    for line in lines:
        if not line.strip():
            (run if run else out).append(line)
            continue
        indent = bool(_INDENT.match(line))
        signs = sum(bool(p.search(line) if k > 2 else p.match(line)) for k, p in enumerate(_CODE_SIGNS))
        pure = not _PROSE.search(line)
        if signs and (pure or signs > 1 or indent) or indent and pure or signs and run:
            run.append(line)
            score += indent + signs + (pure and signs > 0)
            other += signs
        else:
            close()
            out.append(line)
            before = line.rstrip()
    close()
    return "\n".join(out)


def placeholder_weight(text: str) -> int:
    """Weight of unfilled fields and unwritten-part markers outside of code and notation."""
    body = _masked(text)
    got, weak, seen = 0, 0, set()
    for (pattern, weight), signs in zip(_FIELDS, _FIELD_SIGNS, strict=True):
        if not any(x in body for x in signs):
            continue
        for m in pattern.finditer(body):
            if m.span() in seen or _discussed(body, m):
                continue
            seen.add(m.span())
            if weight == 2 or _awaits_value(body, m):
                return 2
            weak += 1
    # names in brackets are fields where there are several, unless they are few in a long text
    if weak >= 2 and DENSITY * weak >= sum(1 for s in _SENT.split(body) if s and not s.isspace()):
        return 2
    got = min(weak, 1)
    low = body.lower()
    for m in _ANGLE.finditer(body) if "<" in body else ():
        name = m.group(1).lower()
        if name.split(" ")[0] in _HTML or f"</{name}>" in low or _discussed(body, m):
            continue
        got += 1 if name in ("title", "date", "time", "summary", "source", "object", "map", "data", "output") and f"<{name}>" == m.group().lower() and len(set(_ANGLE.findall(low))) < 2 else 2
    if got < 2:
        got += 2 * any(any(x in low for x in signs) and p.search(body) for p, signs in zip(_MARKS, _MARK_SIGNS, strict=True))
    return got


def _discussed(body: str, m: re.Match) -> bool:
    """Whether the sign stands in a sentence that explains how such signs are filled, or is quoted in one that talks about them."""
    start, end = _sentence(body, m)
    around = body[start : m.start()] + " " + body[m.end() : end]
    return bool(_EXPLAINS.search(around) or _QUOTED.search(body[max(0, m.start() - 2) : m.start()]) and _ABOUT.search(around))


def _sentence(body: str, m: re.Match) -> tuple[int, int]:
    """Where the line or sentence around a sign starts and ends."""
    start = max(body.rfind(x, 0, m.start()) for x in (". ", "\n", "。"))
    return start + 1, min(x for x in (*(body.find(x, m.end()) for x in (". ", "\n", "。")), len(body)) if x >= 0)


def _awaits_value(body: str, m: re.Match) -> bool:
    """Whether a single field stands where a value should: after a greeting, alone after a colon, or, if it is named after
    a value or numbered, inside a sentence. Sentences about such signs, and about sets, hold none."""
    start, end = _sentence(body, m)
    before, after = body[start : m.start()], body[m.end() : end]
    if _ABOUT.search(before + after):
        return False
    if _GREETING.search(before):
        return True
    numbered = m.group()[1].isdigit()
    named = bool(_VALUE.search(m.group()))
    if numbered and _SET.search(before + after):
        return False
    if _COLON.search(before):
        return named or numbered or m.group()[0] == "[" and not after.strip(" .,;*_")
    if not named and not numbered:
        return False
    return bool(_IN_SENTENCE.search(before)) or not before.strip() and m.group()[0] != "【" and bool(re.match(r" [^\W\d_A-ZÀ-ÞА-ЯЁ]", after))


def is_filler(text: str) -> bool:
    """A run of filler words, keyboard noise, one word or phrase again and again, or a sentence that says it is filler."""
    body = _FENCE.sub("\n", text)
    low = body.lower()
    ws = _WORD.findall(low)
    # runs are looked for only where a text has enough of what they are made of
    n = len(ws)
    if sum(map(_STRONG.__contains__, ws)) >= 3 and _longest(ws, _LATIN.__contains__, 8, lambda run: sum(w in _STRONG for w in run) >= 3):
        return True
    if _MASH_SIGN.search(low) and _longest(ws, lambda w: bool(_MASH.match(w)), 5):
        return True
    if sum(map(eq, ws, ws[1:])) + sum(map(eq, ws, ws[2:])) >= 7:
        again = [i for i in range(1, n) if (ws[i] == ws[i - 1] or i > 1 and ws[i] == ws[i - 2] and ws[i - 1] == ws[max(0, i - 3)]) and not ws[i].isdigit()]
        if any(b - a == 6 for a, b in zip(again, again[6:])):
            return True
    if latin_share(body, len(ws)):
        return True
    if len(_SKELETON.findall(body)) >= 4:
        return True
    if not any(x in low for x in _FILLER_SIGNS) or not _FILLER.search(body):
        return False
    # a sentence that says so is filler unless a text of other content only mentions it
    part = next((s for s in _SENT.split(body) if s and _FILLER.search(s)), "")
    return len(_FILLER.findall(body)) > 1 or not _TEACH.search(part) and (len(_WORD.findall(part)) <= 30)


def _longest(ws: list[str], of, least: int, fine=lambda run: True) -> bool:
    """Whether some run of words of a kind is long enough and fine."""
    return any(ok and len(run := list(g)) >= least and fine(run) for ok, g in groupby(ws, of))


def latin_share(body: str, n: int) -> bool:
    """Whether sentences of nothing but usual filler words make up half of a text of n words, be it ever so short."""
    if "lorem" not in (low := body.lower()) and "ipsum" not in low:
        return False
    own = [ws for s in _SENT.split(low) if len(ws := _WORD.findall(s)) > 1 and all(w in _LATIN for w in ws)]
    return 2 * sum(map(len, own)) >= n > 0


def notice_kind(text: str) -> str | None:
    """'error' or 'scripts' if such a notice stands in place of the content: alone, under a title or menu, or after a
    short opening (at most OPENING words of other content, ideographs counting half)."""
    body = _SPAN.sub(" ", _FENCE.sub("\n", text))
    body = _CLOSED.sub("\n", body)
    other = hits = scripts = 0
    for s in _SENT.split(body):
        s = s.strip()
        if not s or _NAV.match(s):
            continue
        ws = _WORD.findall(s)
        low = s.lower()
        if sum(0.5 if w >= "一" else 1 for w in ws) <= 40 and (len(ws) <= NOTICE_WORDS or any(x in low for x in _STEMS)) and not _TEACH.search(s):
            if _SCRIPTS.search(s):
                scripts += 1
                continue
            if _ERRORS.search(s):
                hits += 1
                continue
        other += sum(0.5 if w >= "一" else 1 for w in ws)
        if other > OPENING:
            return None
    return "scripts" if scripts else "error" if hits else None


def defect(text: str | None) -> str | None:
    """'placeholder', 'filler', 'error' or 'scripts'; None for a sound, null or blank text."""
    if not text or not text.strip():
        return None
    if is_filler(text):
        return "filler"
    kind = notice_kind(text)
    if kind:
        return kind
    return "placeholder" if placeholder_weight(text) >= 2 else None


def residue(documents: DataFrame) -> DataFrame:
    """`doc_id`, `defect` of each document with template residue, filler, an error or block page, or a notice that scripts
    are needed, in place of content. Method: delimiter-specific grammars and regular expressions over the whole text, with
    code blocks, code spans, formulas and data masked, quoted mentions in sentences about templates discounted, and the
    density of notices against other content. Null and blank texts are sound here; repeated rows count once. No shuffle
    but that of the few rows found."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pd.DataFrame({"doc_id": pdf["doc_id"], "defect": [defect(t) for t in pdf["text"]]})
            yield out[out["defect"].notna()]

    return documents.filter("doc_id is not null and text is not null").select("doc_id", "text").mapInPandas(run, "doc_id long, defect string").distinct()
