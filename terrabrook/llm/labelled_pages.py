"""The labelled table of html_text: hand-written pages whose main blocks start with MARK."""

MARK = "§"

PAGES = [
    # an article element between menu, adverts and footer
    """<!DOCTYPE html><html><head><title>River levels</title><style>p{margin:0}</style></head><body>
<nav><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/sport">Sport</a></li></ul></nav>
<div class="ad">Buy two pairs of boots this week and get the third one for free.</div>
<article><h1>§River levels fall for a third week</h1><p>§The river has fallen by another twelve centimetres since Monday, the water office said, and ferries run at half load.</p>
<p>§No rain is in sight.</p><p>§Farmers along the lower valley have begun to draw water from wells, which is allowed until the end of the month.</p><p>§So it was.</p></article>
<footer>&copy; 2021 Valley Post. All rights reserved. Reproduction needs our written leave.</footer></body></html>""",
    # class names only
    """<html><body><div id="header"><h1>The Daily Loaf</h1><p>Bread news since 1988</p></div><div class="menu"><a href="/a">Recipes</a> <a href="/b">Ovens</a> <a href="/c">Shop</a></div>
<div id="content"><h2>§How long should dough rest?</h2><p>§Most bakers let it rest for an hour at room temperature, but a night in the cold gives more taste and a better crust.</p>
<p>§We tried both with the same flour.</p><p>§The slow loaf won with nine of ten tasters, and it kept fresh for two days longer than the quick one.</p></div>
<div class="sidebar"><h3>Popular</h3><ul><li><a href="/1">Ten rolls for guests</a></li><li><a href="/2">Rye without tears</a></li></ul></div>
<div id="footer">Contact the editors by post or telephone. Printed on recycled paper in our own house.</div></body></html>""",
    # no hints at all: tables and paragraphs
    """<html><body><table><tr><td><a href="1.html">Start</a></td><td><a href="2.html">Guest book</a></td><td><a href="3.html">Links</a></td></tr></table>
<h1>§My journey to the north cape</h1><p>§We left on the second of June with two bicycles and a tent that had seen better days, and the first night it rained without pause.</p>
<p>§On the fourth day the road climbed for thirty kilometres and the wind came from the side, so we pushed more than we rode.</p><p>§Nobody complained.</p>
<p>§At the cape itself there was fog, a shop, and a very long queue of buses from all over the continent.</p>
<p><a href="index.html">Back</a> | <a href="top">Top</a> | <a href="mail">Write to me</a></p></body></html>""",
    # main element, in-article extras, comments
    """<html><body class="has-sidebar"><header><a href="/">Skyline</a><p>All about roofs and towers</p></header><main><article><header><h1>§Copper roofs turn green slowly</h1></header>
<p>§A new copper roof is bright for some months, then brown for years, and only after two decades does the green layer close.</p>
<aside><p>Read also: what slate costs and why it lasts for so long on old churches.</p></aside><h2>§Why it happens</h2>
<p>§Salt and sulphur in the air speed it up, so towns on the coast have green roofs sooner.</p><figure><img src="x.png"><figcaption>§A roof after thirty years.</figcaption></figure>
<ul><li>§Sea air speeds it up</li><li>§Clean air slows it down</li></ul><footer>Filed under roofs and metal. Shared 12 times.</footer></article>
<section id="comments"><h3>2 comments</h3><div class="comment"><p>We had ours done in 1990 and it is still brown, I really wonder what we did wrong with it.</p></div><div class="comment"><p>Great post!</p></div></section></main>
<aside><form><label>Your e-mail</label><input name="m"><p>Get our letter once a week, no more than that, and leave whenever you like.</p></form></aside></body></html>""",
    # cookie notice, breadcrumb, share bar, related list
    """<html><body><div id="cookie-consent"><p>We and our partners use cookies to measure how this site is used. You may agree or refuse at any time.</p><button>Agree</button></div>
<div class="breadcrumbs"><a href="/">Home</a> &raquo; <a href="/g">Garden</a> &raquo; Soil</div><div class="post-wrapper"><div class="post"><h1>§Testing your soil at home</h1>
<div class="share">Share this with your friends and neighbours.</div><p>§Take a handful from a spade's depth, wet it, and roll it between your palms.</p><p>§If it forms a long thread it holds much clay; if it falls apart it is sandy.</p>
<p>§Vinegar shows lime: it foams.</p></div><div class="related"><h4>You may also like</h4><p>Our guide to compost, in which we explain how heat kills the seeds of weeds.</p></div></div>
<div class="footer-widgets"><p>Garden Friends is a club of some four hundred members who meet on Sundays.</p></div></body></html>""",
    # German, with short paragraphs and a notice inside
    """<html lang="de"><body><div class="topbar">Heute im Angebot: Winterreifen ab vierzig Euro, solange der Vorrat reicht.</div><nav><a href="/a">Start</a><a href="/b">Politik</a></nav>
<article><h1>§Neue Brücke wird im Mai eröffnet</h1><p>§Nach vier Jahren Bauzeit soll die Brücke über den Fluss im Mai für den Verkehr freigegeben werden, teilte das Amt mit.</p><p>§Die Kosten stiegen.</p>
<div class="notice">Dieser Beitrag ist älter als ein Jahr und wird nicht mehr gepflegt.</div><p>§Fußgänger dürfen sie schon jetzt benutzen.</p></article>
<div id="kommentare" class="comments"><p>Endlich, wir haben lange genug darauf gewartet und fahren immer noch jeden Tag den Umweg!</p></div><footer><p>Impressum und Datenschutz. Alle Angaben ohne Gewähr.</p></footer></body></html>""",
    # French, role attributes
    """<html lang="fr"><body><div role="banner"><p>Le journal du village, tous les jeudis depuis 1950.</p></div><div role="navigation"><ul><li><a href="/">Accueil</a></li><li><a href="/m">Mairie</a></li></ul></div>
<div role="main"><h1>§Le marché revient sur la place</h1><p>§À partir de samedi, les commerçants retrouveront la grande place, fermée depuis un an pour des travaux qui ont duré plus longtemps que prévu.</p>
<p>§Vingt étals sont attendus.</p></div><div role="complementary"><p>La météo de demain : nuages le matin, soleil l'après-midi, vent faible du nord.</p></div><div role="contentinfo">Mentions légales et plan du site.</div></body></html>""",
    # hints missing, link lists before and after, one long text
    """<html><body><div><ul><li><a href="1">Cars</a></li><li><a href="2">Boats</a></li><li><a href="3">Planes</a></li><li><a href="4">All makes and models</a></li></ul></div>
<div><p>§The small plane was built in a barn over eleven winters, and it flew on the first try, which surprised nobody more than its builder.</p>
<p>§It has a motor from a motorcycle and wings of spruce. The cloth came from a sailmaker.</p><p>§A second one is planned.</p></div>
<div><p><a href="5">Previous story: a boat of paper</a></p><p><a href="6">Next story: a car that swims</a></p></div><div>Terms | Privacy | Contact</div></body></html>""",
    # plain text without any element
    "§It rained all night, and in the morning the cellar stood under water.",
    "<p>§Only one paragraph was left of the whole page, but it is a good one and ends properly.</p>",
    "<h1>§Short note</h1><p>§We are closed on Monday.</p>",
    # a form around the page
    """<html><body><form id="page"><div class="nav"><a href="/x">Products</a> <a href="/y">Support</a></div><article><h1>§Changing the filter</h1><p>§Switch the machine off and wait until it is cold.</p>
<p>§Turn the lid to the left, take out the old filter and rinse the case with clear water before the new one goes in.</p><ol><li>§Open the lid</li><li>§Swap the filter</li><li>§Close the lid</li></ol></article></form>
<div class="newsletter"><p>Sign up and get ten per cent off your first order of spare parts.</p></div></body></html>""",
    # sections in main without article, pager, tags
    """<html><body><header><nav><a href="/">Docs</a></nav></header><main><h1>§Storing apples</h1><section><h2>§Choose sound fruit</h2><p>§Bruised apples rot first and infect the others, so eat them at once.</p></section>
<section><h2>§Keep them cool</h2><p>§Between two and four degrees is best, in the dark, one layer deep on slatted shelves.</p><p>§Check weekly.</p></section><div class="tags"><a href="/t/apple">apple</a> <a href="/t/store">store</a></div>
<div class="pagination"><a href="?p=1">1</a> <a href="?p=2">2</a></div></main><div class="sponsored"><p>Shelves of beech, made to measure, delivered within a week to any address.</p></div></body></html>""",
    # no hints, navigation as text, adverts hard to tell
    """<html><body><p>Home - News - Weather - Sport</p><p>§The council met on Tuesday to vote on the new bus line, which will connect the station with the hospital every ten minutes.</p>
<p>§Two members voted against it because of the costs, which are shared by the district and the state.</p><p>§Work starts in spring.</p><p>Imprint</p><p>Contact</p></body></html>""",
    # Spanish, list article
    """<html lang="es"><body><div class="site-header"><p>Cocina de mercado, recetas de temporada para toda la familia.</p></div><div class="entry-content"><h1>§Tres sopas para el invierno</h1>
<p>§La primera lleva puerro y patata, se cuece en media hora y gusta a todos, también a los niños.</p><ol><li>§Sopa de puerro</li><li>§Sopa de ajo con huevo</li><li>§Caldo de verduras</li></ol><p>§Buen provecho.</p></div>
<div class="widget"><h3>Lo más leído</h3><ol><li><a href="/1">Pan sin amasar</a></li><li><a href="/2">Arroz de otoño</a></li></ol></div><div id="respond"><p>Deja un comentario, tu correo no se publica.</p></div></body></html>""",
    # article with a link list and a table
    """<html><body><nav><a href="/">Index</a></nav><article><h1>§Timetable of the cable car</h1><p>§The cabin runs from April to October and carries twelve people; bicycles go free before nine.</p>
<table><tr><th>§Month</th><th>§First</th></tr><tr><td>§April</td><td>§8:00</td></tr><tr><td>§July</td><td>§6:30</td></tr></table><p>§The <a href="/hut">upper hut</a> sells tickets too.</p>
<p><a href="/more">Read more</a></p><p><a href="/also">See all stories about mountains</a></p></article><div class="promo">Rent a sledge at the top station and save three coins.</div></body></html>""",
    # wiki-like page with navigation around named content
    """<html><body><div id="siteNotice"><p>Our yearly meeting takes place in October. Everyone is welcome to join it.</p></div><div id="bodyContent" class="mw-body-content content"><h1>§Lighthouse</h1>
<p>§A lighthouse is a tower with a lamp that warns ships and guides them into harbour.</p><p>§The oldest known one stood on an island before a great port and was counted among the wonders of its age.</p><h2>§Lamps</h2><p>§Oil came first.</p></div>
<div id="mw-navigation"><h2>Navigation menu</h2><ul><li><a href="/m">Main page</a></li><li><a href="/r">Random page</a></li></ul></div><div id="footer"><p>This page was last edited on a Tuesday.</p></div></body></html>""",
    # page without any main text
    """<html><body><nav><ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul></nav><form><label>Name</label><p>Please fill in all fields before you send it.</p></form><footer><p>All prices without tax.</p></footer></body></html>""",
    """<html><body><ul><li><a href="/1">Harbour</a></li><li><a href="/2">Old town and market</a></li><li><a href="/3">Castle</a></li></ul><p><a href="/all">All places</a></p></body></html>""",
    # teasers outside an article
    """<html><body><div class="teaser"><h2>Also today</h2><p>A ship has run aground near the island, and tugs are on their way from two ports.</p></div><article class="story"><h1>§Lights out at seven</h1>
<p>§The town will switch off every second street lamp from December on to save a third of its power bill.</p><p>§Crossings stay lit.</p><p>§The mayor spoke of a trial.</p></article>
<section class="more"><p>In other news, the library opens an hour earlier from Monday and closes later on Friday.</p></section><div><p>The editors are not answerable for what other sites say.</p></div></body></html>""",
    """<html><body><div class="wrap"><p>Welcome to our site, the best place for used clocks in the whole county!</p></div><main><h1>§Winding an old clock</h1><p>§Turn the key slowly and stop when it resists.</p><p>§Once a week is enough.</p></main>
<div><h3>Opening hours</h3><p>We are open on weekdays from nine to six and on Saturdays until noon.</p></div></body></html>""",
    # notices and alerts inside named content, hidden parts
    """<html><body><div class="article-body"><div class="alert">Tickets for the summer fair are on sale now at the usual places.</div><p>§The old mill turns again after a club of volunteers replaced its wheel.</p><div hidden><p>Draft: ask the miller for a photograph before print.</p></div>
<div style="display: none"><p>You have read three of five free stories this month.</p></div><p>§It grinds on Sundays.</p></div><div class="disclaimer"><p>Opinions are those of the authors.</p></div></body></html>""",
    # articles that end, begin or consist of blocks that are no sentences
    """<html><body><nav><a href="/">Home</a></nav><article><h1>§Poems of the coast</h1><p>§Sand on the sill</p><p>§salt on the pane</p><p>§and the bell of the buoy</p></article></body></html>""",
    "<article>§one line without an end</article>",
    "<main><p>§word</p></main>",
    """<article><h2>§Parts</h2><ul><li>§four long screws</li><li>§one plate of oak, planed on both sides</li></ul></article>""",
    """<html><body><article><h1>§Sources and further reading for walkers</h1><p>§The <a href="/1">new map of the moor</a>, a <a href="/2">guide to its birds</a> and <a href="/3">bus times</a> help.</p>
<p>§See <a href="/4">the warden's page</a> for closed paths</p><p><a href="/5">Next: the bog</a></p></article><footer>Moorland Walks since 1999</footer></body></html>""",
    """<html><body><div class="post"><h3>§Photograph of the week</h3><p>§Heron at dawn, by the weir</p></div><div class="post-nav nav"><a href="/o">Older</a></div></body></html>""",
    """<html><body><div class="story-text"><p>§The train stops here twice a day, and once a week it waits for the mail</p><p>§Nobody minds</p></div><div id="ads">Sell your tickets with us</div></body></html>""",
    # an article as the last element, what stands outside of it
    """<html><body><p>Free delivery on all orders over thirty coins until Sunday night.</p><article><h1>§Hedges in winter</h1><p>§Cut them in January, before the birds begin to nest, and leave the cut wood lying below.</p></article></body></html>""",
    """<html><body><article><h1>§Old wells</h1><p>§Cover them.</p></article><p>The keeper of these pages lives on a boat and answers letters in spring and in autumn only.</p><p>Printed in blue</p></body></html>""",
    # no hints: short lines around long paragraphs
    """<html><body><div>Wool &amp; Yarn</div><div>Patterns</div><div>Needles</div><h1>§Washing wool by hand</h1><div>§Use water that is no warmer than your hand, a little soap, and patience, as wool felts when it is rubbed.</div>
<div>§Roll it in a towel to dry it, and lay it flat on a rack away from the sun and from any stove.</div><div>Imprint</div><div>Delivery</div><div>Wool and Yarn Ltd</div></body></html>""",
    """<html><body><p><a href="/1">Log</a> <a href="/2">Crew</a> <a href="/3">Ship</a></p><h2>§Day nineteen</h2><p>§The wind turned to the north at four, and by six we had to take in the large sail and run before it.</p>
<p>§Cook burnt the beans</p><p>§We sighted two whales and a crate of oranges, of which we saved eleven, all sweet and cold.</p><p>Page 19 of 40</p></body></html>""",
    """<html><body><h1>§Fog</h1><p>§The bridge was closed for three hours this morning because drivers could not see the rails.</p></body></html>""",
    """<html><body><p>§To whom it may concern: the key is under the third pot, and the cat must not be let out after dark.</p><p>§Thank you</p></body></html>""",
    """<html><body><div>Menu</div><div>Search</div><div>Login</div><div>Basket (0)</div><div>All rights reserved</div></body></html>""",
    # long texts outside of a marked article
    """<html><body><div><p>This week our shop sends every parcel by bicycle within the ring road, free of charge and before the evening, whatever the weather.</p></div><article><h1>§Moss on stone walls</h1><p>§Leave it.</p>
<p>§It holds water in dry weeks and gives small beetles a home, and it does not harm the stones below in any way.</p></article><div><p>The club that keeps this page was founded by eleven neighbours, and it has since planted more than two thousand trees along the old railway.</p></div></body></html>""",
    """<html><body><main><h1>§Bus line nine</h1><p>§It runs every hour from the square to the baths, and every half hour on days on which the market is held.</p></main>
<div>Other towns have cut their night buses this year, and a survey by the passengers' union shows that most riders would rather pay more.</div><p>Letters to the editor should not be longer than two hundred words and must be signed with a full name and address.</p></body></html>""",
    """<html><body><p>A reader writes that her cat has learnt to open the fridge, and she would like to know what other readers do in such a case.</p><div class="content"><h1>§Keeping cheese</h1><p>§Wrap it in paper.</p>
<p>§Hard cheese lasts for a month in a cool larder, and soft cheese should be eaten within the week in which it was bought.</p></div><p>Our spring catalogue has come from the printer, and you can have it sent to you by post if you ask for it before the end of May.</p></body></html>""",
    # no hints: headings of the text and of link lists
    """<html><body><div><a href="1">Start</a> <a href="2">All stories of this year</a> <a href="3">Shop</a></div><h1>§A well is dug</h1><p>§Two brothers dug for nine days until the bottom turned wet, and on the tenth day the water rose to their knees.</p>
<h2>§How deep it is</h2><p>§Fourteen metres were needed, and the last three went through rock that had to be broken by hand.</p><h3>Latest</h3><div><a href="4">A roof is laid</a></div><div><a href="5">A wall falls</a></div></body></html>""",
    """<html><body><p><a href="1">Home</a> / <a href="2">Fish</a> / <a href="3">Carp and tench in ponds</a></p><h1>§Feeding carp in autumn</h1><p>§Give them less as the water cools, and stop when it is below eight degrees, as they no longer digest what they eat.</p>
<h2>Other pages</h2><p><a href="4">Ice on the pond</a></p><h2>Partners</h2><p><a href="5">Nets and more</a></p></body></html>""",
    """<html><body><div>Village paper, issue twelve</div><h2>§New bell for the chapel</h2><div>§The old one cracked in the frost, and a foundry in the next valley has cast another of the same tone.</div>
<h2>§Lost and found</h2><div>§A grey glove was left at the inn, together with a book about bees, and both can be fetched there in the evening.</div><div>Next issue in June</div></body></html>""",
]
