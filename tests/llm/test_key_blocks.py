"""Key blocks that do not close."""

from siltstone.llm import credentials


def test_an_unclosed_key_block_ends_with_its_key():
    key = "Proc-Type: 4,ENCRYPTED\n\nMIIEpAIBAAKCAQEA7bq\nabcDEF123+/=\n"
    rest = 'password = "xK9#mPq2vL"\nfunc f() {}\n'
    for head, body in (("-----BEGIN RSA PRIVATE KEY-----\n", key), ("-----BEGIN CERTIFICATE-----\n", key), ('if x == "-----BEGIN PRIVATE KEY-----', '"')):
        tail = rest if body == key else " {\n" + rest
        text = head + body + tail
        (a, b, _), *more = credentials.key_blocks(text)
        assert not more and b <= len(head) + len(body) and (body != key or text[a:b].strip() == key.strip())
        assert "xK9#mPq2vL" in [c.value for c in credentials.candidates(text)]
    two = "-----BEGIN PUBLIC KEY-----\nMIIB\n" + rest + "-----BEGIN PRIVATE KEY-----\nMIIC\n-----END PRIVATE KEY-----\n"
    assert [two[a:b].strip() for a, b, _ in credentials.key_blocks(two)] == ["MIIB", "MIIC"]
