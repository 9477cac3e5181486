"""Layouts written by hand."""
import random
def layouts(seed):
    r=random.Random(seed)
    V="the of river harbour mayor engine council winter letters bridge market orchard signal garden copper teacher train window policy ocean school budget painter night museum island".split()
    s=lambda a=6,z=16: " ".join(r.choice(V) for _ in range(r.randint(a,z))).capitalize()+r.choice("...!?")
    P=lambda: " ".join(s() for _ in range(r.randint(2,6)))
    keep,drop=[],[]
    def k(x): keep.append(x); return x
    def d(x): drop.append(x); return x
    L=lambda n: "".join(f'<li class="menu-item menu-item-{i}"><a href="/p{i}">{d(s(1,3)+str(r.random()))}</a></li>' for i in range(n))
    pages=[]
    def page(f):
        keep.clear(); drop.clear(); h=f(); pages.append((h,list(keep),list(drop)))
    page(lambda: f'''<html><body class="single single-post"><div id="page" class="site"><header id="masthead" class="site-header"><p class="site-title"><a href="/">{d(s(2,3))}</a></p><nav id="site-navigation" class="main-navigation"><ul id="primary-menu" class="menu">{L(6)}</ul></nav></header>
<div id="content" class="site-content"><main id="main" class="site-main"><article id="post-81" class="post-81 post type-post status-publish hentry"><header class="entry-header"><h1 class="entry-title">{k(s(4,8))}</h1></header><div class="entry-content"><p>{k(P())}</p><p class="has-text-align-left">{k(P())}</p><div class="wp-block-group overflow-hidden"><p>{k(P())}</p></div><h2 class="wp-block-heading">{k(s(3,6))}</h2><p>{k(P())}</p><blockquote class="wp-block-quote"><p>{k(P())}</p></blockquote></div></article>
<div id="comments" class="comments-area"><h2 class="comments-title">{d(s(2,4))}</h2><ol class="comment-list"><li class="comment"><p>{d(P())}</p></li><li class="comment"><p>{d(P())}</p></li></ol></div></main>
<aside id="secondary" class="widget-area"><section class="widget"><h2 class="widget-title">{d(s(2,3))}</h2><ul>{L(5)}</ul></section></aside></div><footer id="colophon" class="site-footer"><div class="site-info">{d(s(3,6))}</div></footer></div></body></html>''')
    page(lambda: f'''<html><body class="bg-white text-gray-900"><div class="sticky top-0 z-10"><nav class="flex items-center">{"".join(f'<a class="px-3 text-sm" href="/">{d(s(1,2)+str(i))}</a>' for i in range(5))}</nav></div>
<main class="mx-auto max-w-2xl overflow-hidden"><article class="prose lg:prose-xl"><h1 class="text-4xl font-bold">{k(s(4,7))}</h1><div class="grid side-by-side"><p class="lead">{k(P())}</p><p>{k(P())}</p></div><section class="share-price"><h2>{k(s(2,5))}</h2><p>{k(P())}</p><p>{k(P())}</p></section><div class="social-history"><p>{k(P())}</p></div><div class="legal-text"><p>{k(P())}</p></div><div class="text-more"><p>{k(P())}</p></div></article></main>
<div class="newsletter-signup"><form><p>{d(s())}</p><input><button>{d(s(1,2))}</button></form></div><footer class="border-t">{d(s(4,8))}</footer></body></html>''')
    page(lambda: f'''<html><body><table width=100%><tr><td colspan=2>{" | ".join(f'<a href="/{i}">{d(s(1,1)+str(i)+"q")}</a>' for i in range(6))}</td></tr><tr><td width=150><ul>{L(7)}</ul></td><td><h1>{k(s(4,8))}</h1><p>{k(P())}<p>{k(P())}<p>{k(P())}<p>{k(P())}</td></tr></table></body></html>''')
    page(lambda: f'''<html><body><div class="l-header"><div class="c-logo">{d(s(1,2))}</div><div class="c-nav"><ul>{L(6)}</ul></div></div><div class="l-grid"><div class="l-grid__main"><div class="c-article"><h1 class="c-article__headline">{k(s(5,8))}</h1><div class="c-article__standfirst">{k(s(8,14))}</div><div class="c-article__body"><p>{k(P())}</p><p>{k(P())}</p><ul><li>{k(s())}</li><li>{k(s())}</li><li>{k(s())}</li></ul><p>{k(P())}</p><div class="c-ad-slot">{d(s(3,6))}</div><p>{k(P())}</p></div></div></div><div class="l-grid__sidebar sidebar"><h3>{d(s(2,3))}</h3><ul>{L(6)}</ul></div></div><div class="cookie-banner"><p>{d(s())}</p><button>{d(s(1,1)+"z")}</button></div><div class="l-footer footer"><p>{d(s())}</p></div></body></html>''')
    page(lambda: f'''<html><body><a class="skip-link" href="#main">{d(s(2,3))}</a><div role="banner"><h2>{d(s(1,3))}</h2></div><div role="navigation" aria-label="Breadcrumb"><ol>{L(3)}</ol></div><div role="main" id="main"><div class="section-body"><h1>{k(s(3,6))}</h1><p class="summary">{k(P())}</p><h2 id="side-effects">{k(s(2,4))}</h2><p>{k(P())}</p><dl><dt>{k(s(1,3))}</dt><dd>{k(P())}</dd><dt>{k(s(1,3))}</dt><dd>{k(P())}</dd></dl><div class="text-side"><p>{k(P())}</p></div><div aria-hidden="false"><p>{k(P())}</p></div></div></div><div role="complementary"><h2>{d(s(2,3))}</h2><ul>{L(4)}</ul></div><div role="contentinfo"><p>{d(s())}</p></div></body></html>''')
    page(lambda: f'''<html><body><div id="wrap"><div id="top">{"".join(f'<span><a href="/{i}">{d(s(1,2)+str(i)+"t")}</a></span> ' for i in range(5))}</div><div class="storyBody unhidden" itemprop="articleBody"><h1>{k(s(4,7))}</h1>{"".join(f"<p>{k(P())}</p>" for _ in range(7))}<div class="relatedStories"><h4>{d(s(2,3))}</h4><ul>{L(4)}</ul></div><p>{k(P())}</p></div><div style="display: none"><p>{d(P())}</p></div><div class="popup overlay"><p>{d(s())}</p></div></div></body></html>''')
    return pages
