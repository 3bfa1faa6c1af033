"""Byte fixtures."""

import io
import zipfile

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def zipped(**members: str) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, text in members.items():
            archive.writestr(name.replace("__", "/").replace("_xml", ".xml"), text)
    return out.getvalue()


def docx(body: str) -> bytes:
    return zipped(word__document_xml=f'<w:document xmlns:w="{W}"><w:body>{body}</w:body></w:document>')


def run(text: str) -> str:
    return f"<w:r><w:t>{text}</w:t></w:r>"


def eml(*parts: tuple[str, str], multipart: bool = True) -> bytes:
    if not multipart:
        kind, body = parts[0]
        return f"From: a@x\r\nContent-Type: {kind}; charset=utf-8\r\n\r\n{body}\r\n".encode()
    chunks = "".join(f"--b\r\nContent-Type: {kind}; charset=utf-8\r\n\r\n{body}\r\n" for kind, body in parts)
    head = 'From: a@x\r\nMIME-Version: 1.0\r\nContent-Type: multipart/alternative; boundary="b"\r\n\r\n'
    return f"{head}{chunks}--b--\r\n".encode()
