"""Small pages in the layout the extractors expect."""

RACE = "202601140107"


def card(race=RACE):
    times = "".join(f"<td>{10 + i // 2}:{'00' if i % 2 == 0 else '30'}</td>" for i in range(12))
    out = f'<div class="table1"><table><tbody><tr><th>締切予定時刻</th>{times}</tr></tbody></table></div><table><thead><tr><th>枠</th></tr></thead>'
    for k in range(1, 7):
        tall = 'rowspan="4"'
        who = f"444{k} / A1 山田　　{k}郎 東京/大阪 3{k}歳/5{k}.0kg"
        fixed = f'<td {tall} class="is-boatColor{k}">{k}</td><td {tall}>photo</td><td {tall}>{who}</td><td {tall}>F0<br>L1<br>{"-" if k == 6 else "0.1" + str(k)}</td>'
        fixed += f"<td {tall}>6.{k}<br>40.0<br>60.0</td><td {tall}>5.{k}<br>30.0<br>50.0</td><td {tall}>{10 + k}<br>33.3<br>44.4</td><td {tall}>{20 + k}<br>22.2<br>55.5</td><td {tall}></td>"
        runs = [("2", "3", ".12", "１"), (str(k), "5", "F.01", "Ｆ")]
        cells = [[f'<td class="is-boatColor{c}">{n}R</td>' for n, c, _, _ in runs], [f"<td>{c}</td>" for _, c, _, _ in runs],
                 [f"<td>{s}</td>" for _, _, s, _ in runs], [f"<td>{r}</td>" for _, _, _, r in runs]]
        blank = "<td></td>" * 12
        again = "9R" if k == 2 else ""
        rows = [f"<tr>{fixed}{''.join(cells[0])}{blank}<td {tall}>{again}</td></tr>"]
        rows += [f"<tr>{''.join(c)}{blank}</tr>" for c in cells[1:]]
        out += f"<tbody>{''.join(rows)}</tbody>"
    return out + "</table>"


def motor_ranking():
    return """<table><thead><tr><th rowspan="2">順位</th><th colspan="2">モーター</th><th colspan="2">ボート</th><th rowspan="2">前検タイム</th></tr>
<tr><th>番号</th><th>2連対率</th><th>番号</th><th>2連対率</th></tr></thead><tbody>
<tr><td>1位</td><td>12</td><td>45.5%</td><td>3</td><td>20%</td><td>6.71秒</td></tr>
<tr><td>2</td><td>No.7</td><td>-</td><td>9</td><td>10%</td><td>欠</td></tr>
<tr><td>3</td><td>12</td><td>0.0%</td><td>9</td><td>10%</td><td>6.99</td></tr></tbody></table>
<table><thead><tr><th>別表</th></tr></thead><tbody><tr><td>1</td></tr></tbody></table>"""


def payouts():
    def head(place, grade, time, extra=""):
        return (
            f'<th colspan="3" class="is-thColor6"><div class="table1_area type1"><p class="table1_areaName"><img src="x.png" alt="{place}"></p>'
            f'<p class="table1_areaType {grade}"></p><p class="table1_areaTime {time}"></p><p class="table1_areaDate">初日</p>{extra}</div></th>'
        )

    def block(nums, pay, pop):
        spans = "".join(f'<span class="numberSet1_number">{n}</span>' for n in nums) if isinstance(nums, tuple) else nums
        return f"<td>{spans}</td><td><span>{pay}</span></td><td>{pop}</td>"

    lady = '<p class="table1_areaWomen is-lady"></p>'
    return (
        '<table class="is-strited1 is-wAuto"><thead><tr><th>R</th>'
        + head("桐生", "is-G1b", "is-nighter") + head("住之江", "is-ippan", "", lady)
        + "</tr></thead><tbody><tr><th>1R</th>" + block((1, 2, 3), "¥1,230", "4") + block((4, 5, 6), "¥98,760", "101")
        + "</tr><tr><th>2R</th>" + block("不成立", "特払い", "") + block("", "", "") + "</tr></tbody></table>"
    )


def forecast():
    marks = {1: 1, 2: 4}
    rows = ""
    for k in range(1, 7):
        icon = f'<img src="/icon_mark1_{marks[k]}.png">' if k in marks else ""
        rows += f"<tbody><tr><td>{icon}</td><td>{k}</td></tr></tbody>"
    return f'<h3 class="title16__add2020">優勝戦　特別　進入固定</h3><table>{rows}</table>'


def before(early=False):
    boats = ""
    for k in range(1, 7):
        t = 'rowspan="4"'
        boats += (
            f'<tbody><tr><td {t}>{k}</td><td {t}>p</td><td {t}>山田 {k}郎</td><td rowspan="2">5{k}.0kg</td><td {t}>6.7{k}</td><td {t}>-0.5</td><td {t}></td><td {t}>リング</td><td>R</td></tr>'
            f'<tr><td>x</td></tr><tr><td rowspan="2">{k}.5</td><td>ST</td></tr><tr><td>着</td></tr></tbody>'
        )
    order = [1, 3, 2, 4, 5, 6]
    starts = "".join(f"<tr><td>{g} .{c}{c}</td></tr>" for c, g in enumerate(order, 1))
    unit = '<div class="weather1_bodyUnit {css}"><p class="weather1_bodyUnitImage {img}"></p><div class="weather1_bodyUnitLabel"><span class="weather1_bodyUnitLabelTitle">{t}</span><span class="weather1_bodyUnitLabelData">{d}</span></div></div>'
    sky = [("is-direction", "is-direction8", "気温", "16.5℃"), ("is-weather", "", "晴", ""), ("is-wind", "", "風速", "3m"),
           ("is-windDirection", "is-wind13", "", ""), ("is-waterTemperature", "", "水温", "12.0℃"), ("is-wave", "", "波高", "2cm")]
    weather = "".join(unit.format(css=a, img=b, t=c, d=d) for a, b, c, d in sky)
    clock = "0:00現在" if early else "9:10現在"
    return (
        f'<table><tbody><tr><td>x</td></tr></tbody></table><table><thead><tr><th>枠</th></tr></thead>{boats}</table>'
        f'<table><tbody>{starts}</tbody></table><p class="weather1_title">水面気象情報 {clock}</p>{weather}'
    )


def result():
    order = "".join(f"<tbody><tr><td>{r}</td><td>{w}</td><td>444{w} 山田</td><td>1'49</td></tr></tbody>" for r, w in zip("１２３４５Ｆ", (1, 3, 2, 4, 5, 6)))
    starts = "".join(f"<tr><td>{g} {s}</td></tr>" for g, s in ((1, ".10"), (3, ".08"), (2, ".12"), (4, ".12"), (5, ".20"), (6, "F.01")))
    one = "<table><tbody><tr><td>{}</td></tr></tbody></table>".format
    return (
        one("t0") + f"<table><thead><tr><th>着</th></tr></thead>{order}</table>" + f"<table><tbody>{starts}</tbody></table>"
        + "<table><tbody><tr><td>3連単</td><td>1-3-2</td></tr><tr><td></td><td></td></tr></tbody></table>"
        + one("6号艇返還") + one("逃げ") + one("【備考】")
    )


def venues():
    return """<table><tbody><tr><th><div class="table1_area"><p class="table1_areaName"><img src="/img/text_place1_01.png" alt="桐生"></p>
<p class="table1_areaType is-G1b"></p><p class="table1_areaTime is-nighter"></p></div></th></tr></tbody></table>"""


def meetings():
    return """<table><tbody><tr><td class="is-arrow1"><img alt="桐生" src="a.png"></td><td class="is-G1b"></td>
<td class="is-alignL is-fBold is-p10-7">新春カップ</td><td>1/12-1/17<br/>３日目</td></tr></tbody></table>"""


def index():
    cells = "".join(
        f'<tr><td><div class="{"is-lady" if k == 2 else "is-empty"}"></div><a href="/owpc/pc/data/racersearch/profile?toban=444{k}">山田　　{k}郎</a></td></tr>'
        for k in range(1, 7)
    )
    return f"<table><tbody>{cells}</tbody></table>"


def deadlines(cancelled=False):
    head = '<h3 class="title12_title">レース中止</h3>' if cancelled else '<h3 class="title12_title">開催中</h3>'
    times = "".join(f"<td>{10 + i}:{i:02d}</td>" for i in range(12))
    return f'{head}<h2>新春カップ</h2><div class="table1"><table><tbody><tr><th>レース</th></tr><tr><th>締切予定時刻</th>{times}</tr></tbody></table></div>'
