"""Small citation files for the ingest tests."""

HEADER = '<?xml version="1.0" encoding="utf-8"?>\n<!DOCTYPE PubmedArticleSet>\n<PubmedArticleSet>\n'


def article(pmid, title="T", date="<Year>2001</Year>", version="1", body="", journal_extra="", authors=""):
    return f"""<PubmedArticle>
  <MedlineCitation Status="MEDLINE" Owner="NLM">
    <PMID Version="{version}">{pmid}</PMID>
    <Article PubModel="Print">
      <Journal>
        <ISSN>1234</ISSN>
        <JournalIssue CitedMedium="Print">{journal_extra}<PubDate>{date}</PubDate></JournalIssue>
        <Title>Journal of Tests</Title><ISOAbbreviation>J Test</ISOAbbreviation>
      </Journal>
      <ArticleTitle>{title}</ArticleTitle>
      {body}
      {authors}
    </Article>
  </MedlineCitation>
</PubmedArticle>
"""


def deletes(*blocks):
    inner = "".join(
        "<DeleteCitation>" + "".join(f'<PMID Version="1">{i}</PMID>\n' for i in b) + "</DeleteCitation>\n"
        for b in blocks
    )
    return inner


def citation_set(*parts):
    return HEADER + "".join(parts) + "</PubmedArticleSet>\n"


RICH_BODY = """<Pagination><StartPage>289</StartPage><MedlinePgn>289-302</MedlinePgn></Pagination>
<Abstract>
 <AbstractText Label="AIM &amp; SCOPE" NlmCategory="OBJECTIVE">First <i>part</i> cut.</AbstractText>
 <AbstractText Label="EMPTY"/>
 <AbstractText Label='a>b'>Plain &lt;text&gt; with &#x3b1;<!-- note --> end.</AbstractText>
 <AbstractText><b>Starts</b> with markup</AbstractText>
 <AbstractText><![CDATA[raw < & data]]> tail</AbstractText>
</Abstract>
<PublicationTypeList><PublicationType UI="D1">Journal Article</PublicationType><PublicationType>Review</PublicationType></PublicationTypeList>
<KeywordList><Keyword MajorTopicYN="N">alpha</Keyword><Keyword/><Keyword>beta <sub>2</sub></Keyword><Keyword><i>x</i></Keyword></KeywordList>
<ChemicalList><Chemical><NameOfSubstance UI="D2">Aspirin</NameOfSubstance></Chemical></ChemicalList>
<MeshHeadingList><MeshHeading><DescriptorName UI="D3">Humans</DescriptorName><QualifierName>x</QualifierName></MeshHeading>
<MeshHeading><QualifierName>y</QualifierName></MeshHeading><MeshHeading><DescriptorName>Mice</DescriptorName></MeshHeading></MeshHeadingList>"""

RICH_AUTHORS = """<AuthorList CompleteYN="Y"><Author ValidYN="Y"><LastName>Yang</LastName><ForeName>J</ForeName><Initials>J</Initials></Author>
<Author><CollectiveName>The Group</CollectiveName></Author><Author><LastName>Plato</LastName></Author></AuthorList>"""
