"""A small table of labelled URLs for the URL filter: what a reviewer would block, and ordinary pages."""

# Fixed values
BLOCKED = """
http://casino-lucky.example.com/en/play
http://www.casinowin.example.org/slots
https://online-casino.example.net/de/17
http://win-casino-bonus.example.org/es/3
https://poker-win.example.com/en/tables.html
http://free-bets.example.org/en/12
https://bets24.example.com/fr/sport
http://sport-bet-free.example.org/odds
http://freespins.example.net/en/win
https://cheap-pills.example.org/en/4
http://pills-online.example.com/buy.html
http://cheap-meds.example.com/de/pills
https://rx-pharma-cheap.example.net/order
http://buy-viagra.example.com/es/1
https://ads-click.example.com/en/9
http://track-ads.example.org/pixel
https://adtrack.example.net/c/33
http://ads.example.com/banner/8
http://tracker-ads.example.com/en/1.html
https://click-track.example.org/r/2
http://spam-links.example.org/en/71
http://linkfarm.example.com/spam/
https://spam-farm-seo.example.net/de/5
http://seo-spam.example.com/en/backlinks
http://farm-links.example.org/fr/8
https://adult-video.example.com/en/2
http://adult-cams.example.org/x/7
https://xxx-adult.example.net/en/11
http://x-rated.example.com/adult
http://hot-adult-x.example.org/es/9
https://sexcams.example.com/en/live
http://porn-free.example.org/xxx/4
https://payday-loans-cheap.example.com/apply
http://free-iphone-win.example.net/claim
http://replica-cheap.example.org/watches
https://miracle-diet-pills.example.com/en/6
"""

# Fixed values
ALLOWED = """
http://www.library.example.org/en/catalogue
https://www.theatre.example.com/en/2041
https://blog.garden.example.net/fr/311
http://m.weather.example.com/de/7
https://history.example.org/en/1914.html
http://www.museum.example.org/es/88/
https://m.recipes.example.com/en/404
https://blog.mathematics.example.com/en/12
http://stations.example.com/de/5512
https://nations.example.net/en/37
http://www.education.example.org/fr/60
https://motion.example.com/en/8123.html
http://m.election.example.org/en/2020
https://blog.translation.example.com/es/75
http://thermal.example.com/en/9
https://www.thinking.example.org/en/330
http://other-thoughts.example.com/fr/28
https://tables.example.com/en/77
http://ocean.example.org/de/1200
https://www.planes.example.com/en/641/
http://m.bridges.example.net/en/85
https://blog.forest.example.org/fr/9012
http://music.example.com/en/400.html
https://m.chemistry.example.com/de/31
http://www.village.example.com/es/15
https://law.example.org/en/2210
http://blog.hearing.example.com/en/6
https://www.rivers.example.net/fr/417
http://architecture.example.com/en/52/
https://m.physics.example.org/en/3030
http://www.tradition.example.com/fr/19
https://blog.stones.example.com/en/873
http://the-nation.example.org/en/66
https://m.towers.example.com/es/5.html
http://www.printing.example.com/en/1450
https://blog.birds.example.org/de/208
http://school.example.com/en/7
https://www.harbour.example.com/fr/990
http://m.theory.example.com/en/271
https://blog.reading.example.net/es/34
http://edition.example.com/en/101
https://www.gardens.example.org/fr/2
http://m.health.example.com/en/hospital
https://stories.example.com/de/64/
http://blog.hands.example.com/en/18
https://www.orient.example.org/en/4711
http://question.example.com/fr/5
https://m.answers.example.com/en/5656
http://www.dance.example.net/es/12
https://blog.ships.example.com/en/733.html
http://astronomy.example.org/en/90
https://www.winter.example.com/de/1
http://m.fields.example.org/en/320
https://blog.bread.example.com/fr/47
"""


def labelled_urls() -> list[tuple[str, int]]:
    """(url, blocked)."""
    return [(u, 1) for u in BLOCKED.split()] + [(u, 0) for u in ALLOWED.split()]
