"""Image files made inside the tests."""

import struct
import zlib

import numpy as np


def png_bytes(pixels):
    """RGB or grey PNG of a uint8 array."""
    h, w = pixels.shape[:2]
    colour = 2 if pixels.ndim == 3 else 0

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    raw = b"".join(b"\0" + pixels[y].tobytes() for y in range(h))
    head = struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)
    return (
        b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    )


def write_jpeg(spark, pixels, path):
    """JPEG of an RGB uint8 array, by the JVM's own encoder."""
    jvm = spark.sparkContext._jvm
    h, w = pixels.shape[:2]
    kind = jvm.java.awt.image.BufferedImage.TYPE_INT_RGB
    image = jvm.java.awt.image.BufferedImage(w, h, kind)
    rgb = pixels.astype(np.int64) @ np.array([65536, 256, 1])
    for y in range(h):
        for x in range(w):
            image.setRGB(x, y, int(rgb[y, x]))
    assert jvm.javax.imageio.ImageIO.write(image, "jpg", jvm.java.io.File(str(path)))


def gradient(h, w, slope=1.0, shift=0):
    y, x = np.mgrid[0:h, 0:w]
    return np.stack(
        [(x * slope * 255 / w + shift) % 256, (y * 255 / h + shift) % 256, (x + y) % 256], axis=2
    ).astype(np.uint8)


def blobs(h, w, seed):
    """A smooth random picture."""
    rng = np.random.default_rng(seed)
    y, x = np.mgrid[0:h, 0:w] / max(h, w)
    planes = []
    for _ in range(3):
        z = sum(
            a * np.cos(2 * np.pi * (fx * x + fy * y) + p)
            for a, fx, fy, p in zip(rng.random(12), rng.random(12) * 4, rng.random(12) * 4, rng.random(12) * 6)
        )
        planes.append(255 * (z - z.min()) / (z.max() - z.min()))
    return np.stack(planes, axis=2).astype(np.uint8)
